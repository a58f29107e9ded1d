"""The queries of the operators, and SQL where it can express one."""

from __future__ import annotations

from rallyframe.llm import conversations, dropout, embeddings, imatch, interactions, lmscore, packing, planes, secrets, sharding, simhash, suffixes, toxicity

QUERIES = {
    "op1_secret_scan": secrets.query,
    "op2_merge_dropout": dropout.query,
    "op3_nnls_packing": packing.query,
    "op4_subword_toxicity": toxicity.query,
    "op5_pca_tiles": embeddings.query,
    "op6_imatch": imatch.query,
    "op7_cross_entropy_difference": lmscore.query,
    "op8_simhash_variants": simhash.query,
    "op9_virtual_slots": sharding.query,
    "op10_bit_planes": planes.query,
    "op11_filter_orders": interactions.query,
    "op12_structure_repair": conversations.query,
    "op13_difference_cover": suffixes.query,
}

ORACLES: dict[str, str] = {
    "op5_pca_tiles": """WITH RECURSIVE usable AS (SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
 links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
 reach(node, root) AS (SELECT vec_id, vec_id FROM usable UNION SELECT l.b, r.root FROM reach r JOIN links l ON l.a = r.node),
 least AS (SELECT node, min(root) AS root FROM reach GROUP BY 1), many AS (SELECT a, count(*) AS n FROM links GROUP BY 1)
 SELECT v.vec_id, coalesce(n, 0) AS n_links, coalesce(root, v.vec_id) AS component_id, coalesce(root, v.vec_id) = v.vec_id AS kept
 FROM embeddings v LEFT JOIN least ON node = v.vec_id LEFT JOIN many ON a = v.vec_id""",
    "op11_filter_orders": interactions.ORACLE,
}
