"""Registered queries of this package and the SQL they must agree with."""

from __future__ import annotations

from claimflow.llm import (
    decontaminate,
    divergence,
    jaccard_join,
    licenses,
    merkle,
    mixing,
    paragraphs,
    quality,
    quotations,
    toxicity,
    url_rules,
    vectors,
    warc,
)

QUERIES = {
    "op1_jaccard_join": jaccard_join.query,
    "op2_quotations": quotations.query,
    "op3_paragraphs": paragraphs.query,
    "op4_decontaminate": decontaminate.query,
    "op5_toxicity": toxicity.query,
    "op6_licenses": licenses.query,
    "op7_url_rules": url_rules.query,
    "op8_quality": quality.query,
    "op9_vectors": vectors.query,
    "op10_mixing": mixing.query,
    "op11_merkle": merkle.query,
    "op12_warc": warc.query,
    "op13_divergence": divergence.query,
}
ORACLES = {
    "op1_jaccard_join": jaccard_join.SQL,
    "op2_quotations": quotations.SQL,
    "op6_licenses": licenses.SQL,
    "op7_url_rules": url_rules.SQL,
    "op9_vectors": vectors.SQL,
    "op10_mixing": mixing.SQL,
    "op11_merkle": merkle.SQL,
    "op12_warc": warc.SQL,
    "op13_divergence": divergence.SQL,
}
