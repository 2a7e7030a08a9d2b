"""Column-expression builders; see ``codes``."""
