"""Web-search analytics on Spark: page text, links, TF-IDF index, PageRank, search, crawl planning."""
