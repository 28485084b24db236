"""Table-level jobs: functions from input tables to one result table."""
