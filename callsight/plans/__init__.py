"""Named end-to-end plans (driver queries) and the test-table mapping they read."""
