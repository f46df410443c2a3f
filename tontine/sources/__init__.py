"""Sources and sinks: raw-table schemas, assumption builders/loaders, driver adapters, writers."""
