"""Instants that the tests build their rows from."""

BASE = 1_700_000_000_000_000_000
SECOND = 1_000_000_000
MINUTE = 60 * SECOND
