"""Sources: line files and their parsers (``text``) and the fixture inputs derived from the
driver's parquet tables (``fixtures``)."""
