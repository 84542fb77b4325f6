"""Declared schemas.  Nothing is inferred from data."""

from pyspark.sql import types as T

_S, _D, _TS = T.StringType(), T.DoubleType(), T.TimestampType()


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


# API response: one envelope per landed file
RAW_ARTICLE = _struct(
    uri=_S, url=_S, title=_S, body=_S, date=_S, dateTime=_S, sentiment=_D, wgt=_D,
    relevance=_D, sim=_D, image=_S,
    source=_struct(title=_S, location=_struct(country=_struct(label=_struct(eng=_S)))),
    categories=T.ArrayType(_struct(label=_S)),
)
RAW_RESPONSE = _struct(
    articles=_struct(totalResults=T.LongType(), results=T.ArrayType(RAW_ARTICLE)),
    fetched_at=_S, topic_name=_S, topic_key=_S,
)

# Article table, single-topic variant (12 columns) and topics variant (15)
ARTICLE_12 = _struct(
    doc_id=_S, title=_S, content=_S, description=_S, link=_S, published_at=_TS, source=_S,
    source_type=_S, topic_name=_S, topic_key=_S, categories=T.ArrayType(_S),
    ingestion_timestamp=_TS,
)
ARTICLE_15 = T.StructType(ARTICLE_12.fields + _struct(sentiment=_D, wgt=_D, image=_S).fields)

RSS_ITEM = _struct(title=_S, link=_S, description=_S, pubDate=_S)
AGENCY_RESPONSE = _struct(items=T.ArrayType(_struct(
    id=_S, title=_S, body=_S, excerpt=_S, url=_S, date=_S, type=_S, categories=T.ArrayType(_S))))
QUERY_RESPONSE = _struct(
    query=_S,
    articles=T.ArrayType(_struct(
        source=_struct(id=_S, name=_S), author=_S, title=_S, description=_S, url=_S,
        urlToImage=_S, publishedAt=_S, content=_S)),
)

PROPERTIES = T.MapType(_S, _S)
NODE = _struct(id=_S, type=_S, properties=PROPERTIES)
RELATIONSHIP = _struct(source=_S, target=_S, type=_S, properties=PROPERTIES)
GRAPH = _struct(nodes=T.ArrayType(NODE), relationships=T.ArrayType(RELATIONSHIP))
ENRICHED = _struct(
    doc_id=_S,
    metadata=_struct(id=_S, title=_S, description=_S, link=_S, published_at=_S, source=_S,
                     source_type=_S, categories=T.ArrayType(_S)),
    entities=T.ArrayType(_S), entities_by_type=T.MapType(_S, T.ArrayType(_S)), graph=GRAPH,
)

SPAN = _struct(start=T.IntegerType(), end=T.IntegerType())
CLUSTERS = T.ArrayType(T.ArrayType(SPAN))

# Driver tables read as streams need their schema up front
DOCUMENTS = _struct(doc_id=T.LongType(), text=_S, lang=_S, source=_S, n_chars=T.LongType())
EVENTS = _struct(event_id=T.LongType(), ts=T.TimestampNTZType(), user_id=T.LongType(),
                 event_type=_S, value=_D, props=_S)
