"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from pluvial.llm.alignment import op13_alignment
from pluvial.llm.ann import op9_ann
from pluvial.llm.common import shipped
from pluvial.llm.divergence import ORACLE as _OP12
from pluvial.llm.divergence import op12_divergence
from pluvial.llm.extract import op7_extract
from pluvial.llm.langid import op6_langid
from pluvial.llm.lmscoring import op11_lmscoring
from pluvial.llm.mixing import op4_mixing
from pluvial.llm.packing import op10_packing
from pluvial.llm.quality import op5_quality
from pluvial.llm.secrets import op2_secrets
from pluvial.llm.semdedup import op8_semdedup
from pluvial.llm.simhash import op3_simhash
from pluvial.llm.toxicity import op1_toxicity

QUERIES = {f.__name__: shipped(f) for f in (
    op1_toxicity, op2_secrets, op3_simhash, op4_mixing, op5_quality, op6_langid, op7_extract,
    op8_semdedup, op9_ann, op10_packing, op11_lmscoring, op12_divergence,
    op13_alignment)}

#: Links are counted pair by pair, components by a recursive walk.
_OP8 = """
WITH RECURSIVE ok AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b
    ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.95),
reach(start, node) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT r.start, l.b FROM reach r JOIN link l ON l.a = r.node),
least AS (SELECT start AS vec_id, min(node) AS component_id FROM reach GROUP BY start),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM link GROUP BY a)
SELECT l.vec_id, CAST(coalesce(n.n_links, 0) AS BIGINT) AS n_links, l.component_id,
       l.vec_id = l.component_id AS kept
FROM least l LEFT JOIN n USING (vec_id)
"""

ORACLE_SQL = {"op8_semdedup": _OP8, "op12_divergence": _OP12}
