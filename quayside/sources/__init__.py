"""Sources: the raw table, CSV landing files, and the test-fixture adapter."""
