"""End-to-end plans: the registered queries (``queries``), their DuckDB oracles (``oracle``)
and the reference's programs as file-to-file jobs (``jobs``)."""
