"""Plans: named queries over the test tables, weekly jobs and dated series."""
