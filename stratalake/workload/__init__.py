"""The registered queries: operators run over the given tables, each with its SQL."""
