"""Tables with snapshots, time travel, DELETE and UPDATE."""
