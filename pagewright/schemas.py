"""Table schemas shared by the batch and streaming jobs."""

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _schema(**columns) -> StructType:
    return StructType([StructField(name, kind()) for name, kind in columns.items()])


URLS = _schema(id=LongType, url=StringType)
CRAWLER_DOCS = _schema(id=LongType, content=StringType, type=StringType)
LINKS_URL = _schema(source=StringType, dest=StringType)
CRAWLER_CONTENT = _schema(
    id=LongType, title=StringType, content=StringType, headers=StringType, body=StringType
)
INVERTED_INDEX = _schema(id=LongType, term=StringType, weight=DoubleType)
IDFS = _schema(term=StringType, idf=DoubleType)
DOMAINS = _schema(source=StringType, dest=StringType)
PAGERANK_RESULTS = _schema(domain=StringType, rank=DoubleType)
URL_SEEN = _schema(url=StringType, last_crawled=TimestampType)
FRONTIER = _schema(url=StringType, date_added=TimestampType)
# the last three may be null: an unknown status counts as a success, no final URL as no redirect
FETCHED_PAGES = _schema(
    url=StringType,
    document=StringType,
    type=StringType,
    fetched_at=TimestampType,
    status=IntegerType,
    content_length=LongType,
    final_url=StringType,
)
# what a crawl remembers: contents met, pages fetched, requests made per domain
CONTENT_SEEN = _schema(hash=StringType, fetched_at=TimestampType)
PAGE_SEEN = _schema(url=StringType, last_crawled=TimestampType, hash=StringType)
DOMAIN_REQUESTS = _schema(domain=StringType, last_request=TimestampType)
QUERIES = _schema(qid=LongType, query=StringType)
