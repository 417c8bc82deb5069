"""DataFrame operators shared by the corpora."""
