"""The queries of the correctness gate and their counterparts in plain SQL."""
