"""Schemas of the tables that the engine reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, B = T.StringType(), T.IntegerType(), T.BooleanType()
TEXTS = T.ArrayType(S)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in fields.items()])


QUALIFIER = _struct(id=S, time=S, precision=I, text=S)
STATEMENTS = _struct(subject=S, pid=S, stmt_ord=I, rank=S, value_kind=S, value_id=S, value_time=S, time_precision=I, value_text=S, qualifiers=T.MapType(S, T.ArrayType(QUALIFIER)))
ENTITIES = _struct(qid=S, label_en=S, description_en=S, aliases_en=TEXTS)
NAMES = _struct(qid=S, name=S, norm_name=S, is_alias=B)

TEMPLATES = _struct(
    tpl_ord=I, domain=S, topic=S, answer_type=S, question_family=S, subject_type_qid=S, subject_type_label=S, date_property_pid=S, target_property_pid=S, target_property_label=S,
    canonical_question_template=S, answer_format=S, date_answer_granularity=S, composition_style=S, reasoning_style=S, temporal_mode=S,
    reasoning_recipe=_struct(required_reasoning_clues=TEXTS, surface_bridge_entities=B, new_element_slot=S, new_element_hop=I),
    status=S, evidence_status=S, evidence_runs=TEXTS, evidence_notes=S, exact_instance_only=B, retrieval_limit=I,
)

HOP = _struct(source_qid=S, source_label=S, property_pid=S, property_label=S, target_qid=S, target_label=S, role=S, qualifiers=T.MapType(S, S))
BRIDGE = _struct(qid=S, label=S, role=S)
NEWNESS = _struct(anchor_kind=S, anchor_property_pid=S, anchor_value=S, reason=S, what_is_new=S)
DERIVATION = _struct(style=S, rule=S, selected_end_date=S, selected_degree_qid=S, bridge_property_pid=S, answer_property_pid=S, ordinal_value=I, ordinal_rendered=S, series_property_pid=S, date_property_pid=S)
ORDINAL = _struct(ordinal_value=I, ordinal_rendered=S, edition_qid=S, series_qid=S, descriptor=S, series_label_raw=S, series_history_complete=B, series_property_pid=S, date_property_pid=S)
COMPOSED = _struct(person_qid=S, spouse_qid=S, birth_dates=TEXTS, marriage_start=S, selected_university_qid=S, selected_degree_qid=S, selected_degree_label=S, selected_end_date=S)
SOURCE = _struct(
    wikidata_access_date=S, retrieval_method=S, sparql_query=S, subject_description=S, subject_type_labels=TEXTS, subject_location_labels=TEXTS, answer_subdivision_labels=TEXTS,
    question_format_args=_struct(subject_kind=S, descriptor=S, ordinal=S), subject_label_source=S, answer_label_source=S,
    composed_from=COMPOSED, multi_hop_unique=B, required_reasoning_clues=TEXTS, bridge_labels=TEXTS, ordinal_metadata=ORDINAL, surface_bridge_entities=B,
)
SHORTCUT = _struct(applies=B, question_requires_all_hops=B, shortcut_free=B)
FLAGS = _struct(
    no_year=B, no_temporal_expression=B, answer_unique=B, subject_unique_under_question=B, answer_not_leaked=B, location_context_not_leaked=B, bridge_not_leaked=B,
    question_requires_all_hops=B, shortcut_free=B, provenance_complete=B, llm_rewrite_used=B, rewrite_failure_reason=S,
)

CANDIDATES = T.StructType(
    _struct(
        tpl_ord=I, cand_ord=I, subject_qid=S, subject_label=S, subject_aliases=TEXTS, domain=S, topic=S, answer_type=S, question_family=S, subject_type_qids=TEXTS,
        target_property_pid=S, target_property_label=S, answer_qids=TEXTS, answer_labels=TEXTS, answer_aliases=TEXTS, date_property_pid=S, date_value=S, target_time=S,
        canonical_question=S, rewritten_question=S, ambiguity_status=S, disambiguation_signature=TEXTS, competitor_qids=TEXTS, validation_flags=FLAGS, newness_metadata=NEWNESS,
        reasoning_style=S, hop_count=I, reasoning_path=T.ArrayType(HOP), bridge_entities=T.ArrayType(BRIDGE), derivation_signature=DERIVATION, shortcut_checks=SHORTCUT,
        provenance_complete=B, question_requires_all_hops=B, source_metadata=SOURCE,
    ).fields
)
