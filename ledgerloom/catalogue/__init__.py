"""The registered queries, the sample views they read, and their SQL twins."""
