"""Writers: raw landing, stage layout, day-partitioned history, snapshots."""
