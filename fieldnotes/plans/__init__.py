"""The model graph wired end to end, and the named-query registry."""
