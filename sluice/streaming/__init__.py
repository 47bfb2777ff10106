"""File-arrival streams; every batch is written so that a replay changes nothing."""
