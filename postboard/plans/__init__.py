"""Complete queries over the tables of a folder."""
