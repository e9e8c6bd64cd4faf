"""The daily job over files as they land."""
