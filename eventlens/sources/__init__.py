"""Sources: driver tables, replay of the contract view, lake, CSV, Kafka."""
