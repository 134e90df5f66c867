"""Jobs: the layered corpus, its quality gate, and the star-schema reports."""
