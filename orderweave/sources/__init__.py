"""Tables, record topics, snapshots, reports and generators."""
