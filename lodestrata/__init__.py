"""A PySpark-native engine for evidence collections: capture, identity, lines, spans, packets, mentions, graphs, ranking and rules."""
