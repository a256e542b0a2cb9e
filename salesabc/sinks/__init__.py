"""Writers: fact table, Pareto tables, CSV, Markdown."""
