"""Sources and sinks: message logs, point clouds, annotation tables, shards, reports."""
