"""Reading tables, catalogs and versioned state."""
