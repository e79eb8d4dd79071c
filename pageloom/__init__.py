"""Page-corpus analytics on Spark: parse page dumps, profile them, cluster them, link them."""
