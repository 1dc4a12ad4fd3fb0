"""The registered queries: the library's operators over an archive derived from the given tables."""
