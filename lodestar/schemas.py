"""Declared schemas of the inputs; JSON and text are never read with inferred ones."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _L, _D = T.StringType(), T.LongType(), T.DoubleType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


SOURCE_LIST = _struct(slug=_S, name=_S, vendor=_S, website_url=_S, categories=T.ArrayType(_S), primary_category=_S)
VOCABULARY = _struct(slug=_S, name=_S, description=_S)
TERM = _struct(slug=_S, label=_S)
FACETS = T.MapType(_S, T.ArrayType(TERM))
QUESTION = _struct(q=_S, a=_S)
RAW_TOOLS = _struct(**dict.fromkeys("slug name vendor website_url source_url source_hash raw_title raw_meta_desc raw_text categories_json primary_category status collected_at".split(), _S))
ENRICHED_TOOLS = _struct(
    **dict.fromkeys("slug short_desc description_md pros_json cons_json faq_json seo_title seo_description application_category pricing pricing_note".split(), _S), quality_score=_D, content_hash=_S, enriched_at=_S
)
TOOL_EMBEDDINGS = _struct(slug=_S, model=_S, dim=T.IntegerType(), embedding_json=_S, content_hash=_S, created_at=_S)
DEDUP_MAP = _struct(slug=_S, canonical_slug=_S, reason=_S, score=_D, prev_status=_S, detected_at=_S)
ALTERNATIVES = _struct(tool_id=_L, alternative_id=_L, similarity=T.DecimalType(4, 3), reason=_S)
SEARCH_EMBEDDINGS = _struct(tool_id=_L, embedding=T.ArrayType(T.FloatType()), updated_at=T.TimestampType())
TOOL_TAGGING = _struct(tool_slug=_S, facets=T.MapType(_S, T.ArrayType(_S)), tags=T.ArrayType(TERM))
RUNS = _struct(step=_S, ok=T.BooleanType(), critical=T.BooleanType(), message=_S, started_at=T.TimestampType(), seconds=_D)
