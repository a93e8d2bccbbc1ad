"""The keyed operators over streams: what ``pagemill.operators.stateful`` gives for a table, row by row as it comes (keyed)."""
