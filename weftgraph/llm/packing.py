"""Tokenised documents packed into sequences by vector best-fit.

A sequence has three capacities: tokens, documents, and attention cost (the sum of its pieces'
squared lengths). Pieces are dealt into shards of about ``per_shard`` pieces; within a shard
they are placed in falling order of length, each into the open sequence that fits it best under
every capacity: the one whose weighted residual has the smallest norm afterwards, or the largest
weighted dot product of piece and residual. A shard leaves one sequence partly empty or so,
against the thousands it fills; no shard depends on another.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.llm import blocks as B
from weftgraph.llm.spans import binary_array
from weftgraph.session import cut_lineage

END_ID = 0
_KNOWN_WORDS = 700_000
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds at most, and what weight each residual has. None: no bound of its own."""

    tokens: int = 2048
    documents: int | None = None
    cost: int | None = None
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    rule: str = "norm"

    def limits(self) -> np.ndarray:
        return np.array([self.tokens, self.documents or self.tokens, self.cost or self.tokens**2], np.float64)


# All ASCII marks but the apostrophe, which the tokenizer may tie to letters behind it.
_MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")


def _ends_in_letter(word: bytes) -> bool:
    """Whether the tokenizer splits between this word and a mark; a letter that lower case turns
    into letter and combining mark does not count."""
    if word[-1:] < b"\x80":
        return word[-1:].isalnum()
    last = word.decode("utf-8", "replace")[-1]
    return last.isalpha() and last.lower().isalpha()


# Letters and digits are 1, marks 2, so that 3 is the sum where one meets the other and nowhere else.
_KIND = np.zeros(256, np.int8)
_KIND[[c for c in range(128) if chr(c).isalnum()]] = 1
_KIND[list(_MARKS)] = 2
# Case matters where a capital and a mark that combines with it follow: the small letter may have a form with it.
_COMBINES = re.compile(rb"[A-Z][\xcc\xcd]")
# Lower-case letters that neither the normaliser changes nor lower case turns into more than one.
_PLAIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")
_CAPITALS = {c: c + 32 for c in range(0xC0, 0xDF) if c != 0xD7}


def _byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for
    themselves, the others for the first ones from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class _Words:
    """Ids of words as little-endian bytes.

    The tokenizer lowers case and splits at white space and between a letter or digit and a mark
    before anything else, so a text's ids are those of its lower-case words one after the other, and
    a word's are those of its letters and of the marks behind. A word of plain letters goes to the
    tokenizer's model at once. Each worker keeps the words it has met in two generations: a full one
    becomes the older, what is met again moves to the younger. A text that holds the string of a
    special token, or a capital with a combining mark, goes through the tokenizer whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.letters = {i: c for i, c in enumerate(_byte_letters())}
        names = self.tokenizer.get_vocab()
        self.closes = np.zeros(max(names.values()) + 1, bool)
        self.closes[[i for name, i in names.items() if name.endswith("</w>")]] = True

    def ids(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[bytes]:
        """The ids of each text; each word of the block is looked up once, new ones are encoded together."""
        lower = _LOWER[data]
        start, end, at = B.words(lower, offsets)
        # Parts of words are looked up where the tokenizer parts them in any case.
        kind = _KIND[lower]
        cuts = np.setdiff1d(np.flatnonzero(kind[1:] + kind[:-1] == 3) + 1, offsets)
        start = np.sort(np.concatenate([start, cuts]))
        end = np.sort(np.concatenate([end, cuts]))
        at = np.searchsorted(start, offsets)
        words = binary_array(lower[B.in_words(lower)], np.append(0, np.cumsum(end - start)), pa.binary())
        coded = words.dictionary_encode()
        letters, edges = B.text_bytes(coded.dictionary)
        letters, edges = letters.tobytes(), edges.tolist()
        met = [letters[a:b] for a, b in zip(edges[:-1], edges[1:])]
        if len(self.young) + len(met) > _KNOWN_WORDS:
            self.young, self.old = {}, self.young
        found = [self.young.get(w) for w in met]
        missing = [i for i, known in enumerate(found) if known is None]
        self._learn({met[i] for i in missing})
        for i in missing:
            found[i] = self.young[met[i]]
        length = np.fromiter(map(len, found), np.int64, len(found)) // 4
        first = np.cumsum(length) - length
        known = np.frombuffer(b"".join(found), "<u4")
        code = coded.indices.to_numpy()
        size = length[code]
        ends = np.append(0, np.cumsum(size))
        ids = known[np.repeat(first[code] - ends[:-1], size) + np.arange(ends[-1])].tobytes()
        whole, low = data.tobytes(), lower.tobytes()
        odd = self._needs_whole(whole, low)
        ends_at = (4 * ends[at]).tolist()
        for a, b, x, y in zip(ends_at[:-1], ends_at[1:], offsets[:-1].tolist(), offsets[1:].tolist()):
            if odd and self._needs_whole(whole[x:y], low[x:y]):
                text = whole[x:y].decode("utf-8", "replace")
                yield np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
            else:
                yield ids[a:b]

    def _needs_whole(self, text: bytes, low: bytes) -> bool:
        """Whether a text cannot be taken word by word. Words are handed over in lower case, which may make
        a special token's string of something else."""
        return any(s in low for s in self.special) or _COMBINES.search(text) is not None

    def _plain(self, letters: str) -> bytes:
        return array("I", [token.id for token in self.model.tokenize(letters)]).tobytes()

    def _encoded(self, words: list[str]) -> list[bytes]:
        """The ids of each word. As one text if every word ends in exactly one closing id."""
        ids = np.array(self.tokenizer.encode(" ".join(words), add_special_tokens=False).ids, "<u4")
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) == len(words) and all(map(str.isalpha, words)):
            whole, cuts = ids.tobytes(), (4 * ends).tolist()
            return [whole[a:b] for a, b in zip([0, *cuts], cuts)]
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _learn(self, met: set[bytes]) -> None:
        young, old = self.young, self.old
        whole, split = set(), []
        for word in met.difference(young):
            if word in old:
                young[word] = old[word]
                continue
            if word.isalpha():
                young[word] = self._plain(word.decode())
                continue
            core = word.rstrip(_MARKS)
            if len(core) < len(word) and _ends_in_letter(core):
                split.append((word, core, word[len(core) :]))
                whole |= {core, word[len(core) :]}
            else:
                whole.add(word)
        # Plain words first, so that whole parts take the quick way.
        texts = []
        for w in whole.difference(young):
            text = w.decode("utf-8", "replace").translate(_CAPITALS)
            if _PLAIN.fullmatch(text):
                young[w] = self._plain(text.encode().decode("latin-1").translate(self.letters))
            else:
                texts.append((text, w))
        # Words of letters first, so that whole parts take the quick way.
        texts.sort(key=lambda pair: not pair[0].isalpha())
        for at in range(0, len(texts), 1000):
            part = texts[at : at + 1000]
            young.update(zip((w for _, w in part), self._encoded([s for s, _ in part])))
        for word, core, marks in split:
            young[word] = young[core] + young[marks]


_words: dict[str, _Words] = {}


def tokenize(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", tokens: int = 2048, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``tokens`` ids: doc_id, piece, start, length, ids_crc32 (and ids).

    A document's ids are the tokenizer's, then ``END_ID``; only a longer document is cut. A null or
    empty text is the end id alone. ``path`` names a tokenizer file every executor can read.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words.get(path)
        if words is None:
            words = _words[path] = _Words(path)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            doc_ids = B.column(batch, "doc_id")
            for first, _, data, offsets in B.blocks(B.column(batch, "text"), 1 << 21):
                row, piece, start, length, crc, ids = [], [], [], [], [], []
                for r, encoded in enumerate(words.ids(data, offsets)):
                    encoded += end
                    for k, at in enumerate(range(0, len(encoded), 4 * tokens)):
                        part = encoded[at : at + 4 * tokens]
                        row.append(first + r)
                        piece.append(k)
                        start.append(at // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        if with_ids:
                            ids.append(np.frombuffer(part, "<i4"))
                columns = [doc_ids.take(pa.array(row, pa.int64())), *(pa.array(x, pa.int64()) for x in (piece, start, length, crc))]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays([columns[0], columns[1].cast(pa.int32()), *columns[2:]], names=names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    frame = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    return frame.mapInArrow(emit, schema)


def place(lengths: np.ndarray, capacity: Capacity) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset in it) of each piece, longest pieces first."""
    limits, weights = capacity.limits(), np.array(capacity.weights)[:, None]
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    demands = np.stack([lengths, np.ones(len(lengths)), lengths.astype(np.float64) ** 2])
    residual = np.empty((3, 64))
    number = np.empty(64, np.int64)
    open_, made = 0, 0
    shortest = lengths.min() if len(lengths) else 0
    for p in np.argsort(-lengths, kind="stable").tolist():
        demand = demands[:, p : p + 1]
        left = residual[:, :open_] - demand
        fits = np.flatnonzero((left >= 0).all(axis=0))
        if len(fits):
            share = (left if capacity.rule == "norm" else residual[:, :open_])[:, fits] / limits[:, None]
            if capacity.rule == "norm":
                best = fits[(weights * share**2).sum(axis=0).argmin()]
            else:
                best = fits[(weights * share * demand / limits[:, None]).sum(axis=0).argmax()]
        else:
            if open_ == residual.shape[1]:
                residual = np.concatenate([residual, np.empty_like(residual)], axis=1)
                number = np.concatenate([number, np.empty_like(number)])
            best = open_
            residual[:, best], number[best] = limits, made
            open_, made = open_ + 1, made + 1
        sequence[p], offset[p] = number[best], limits[0] - residual[0, best]
        residual[:, best] -= demand[:, 0]
        if residual[0, best] < shortest or residual[1, best] < 1:
            open_ -= 1
            residual[:, best], number[best] = residual[:, open_], number[open_]
    return sequence, offset


def pack(pieces: DataFrame, capacity: Capacity = Capacity(), per_shard: int = 8192) -> DataFrame:
    """``pieces`` with sequence_id and offset; every piece is in one place, gapless from 0.

    ``pieces`` has doc_id, piece and length, each length from 1 to the token capacity (and its
    square within the cost capacity). Equal pieces are all placed. No pieces, no sequences.
    """
    shards = -(-pieces.count() // per_shard) or 1

    def of_shard(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        sequence, offset = place(table["length"].to_numpy(), capacity)
        shard = table["_shard"].to_numpy()
        table = table.drop_columns(["_shard"])
        return table.append_column("sequence_id", pa.array((shard << 32) + sequence)).append_column("offset", pa.array(offset))

    dealt = pieces.withColumn("_shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shards)))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    return dealt.groupBy("_shard").applyInArrow(of_shard, schema)


def pack_documents(docs: DataFrame, path: str, capacity: Capacity = Capacity(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Tokenise and pack: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Extra columns are left behind; null ids are kept; repeated rows are packed each.
    """
    return pack(cut_lineage(tokenize(docs, path, id_col, text_col, capacity.tokens)), capacity)
