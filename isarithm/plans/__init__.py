"""Named queries: each operator applied to the tables of a data folder, beside its SQL."""
