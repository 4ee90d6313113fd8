"""SQL that gives the same rows as queries of this subpackage, by plain comparison instead of their methods."""

from __future__ import annotations

from loomquill.functions.text import SPACE
from loomquill.llm.survivor import ATTRIBUTES, FILLERS

WORD = r"[\p{L}\p{N}]+"


def _strip(c: str) -> str:
    return f"regexp_replace({c}, '^{SPACE}+|{SPACE}+$', '', 'g')"


_FILLED = "(" + ", ".join(f"'{f}'" for f in FILLERS) + ")"


def _winner(a: str) -> str:
    return f"SELECT group_id, '{a}' AS attr, rec_id FROM ({_best(a)})"


def _best(a: str) -> str:
    value = f"metadata.{a}"
    valid = f"{value} >= 1" if a == "page" else f"{value} IS NOT NULL" if a in ("caption", "chartqa", "ocr") else f"lower({_strip(value)}) NOT IN {_FILLED}"
    return f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY trust DESC, taken DESC, rec_id) AS n FROM g WHERE {valid}) WHERE n = 1"


P3_FOUND = f"""WITH p AS (SELECT *, {_strip("metadata.image_path")} AS given FROM (SELECT DISTINCT * FROM img_docs) WHERE metadata.image_path IS NOT NULL),
q AS (SELECT *, replace(CASE WHEN lower(given) LIKE 'file:%' THEN url_decode(regexp_replace(given, '^file:(//[^/]*)?', '', 'i')) ELSE given END, '\\', '/') AS plain FROM p WHERE given <> ''),
r AS (SELECT *, list_filter(string_split(CASE WHEN plain LIKE '/%' THEN plain ELSE coalesce(source_dir, '') || '/' || plain END, '/'), lambda x: x <> '' AND x <> '.') AS parts FROM q),
s AS (SELECT *, nfc_normalize('/' || array_to_string(list_reduce(list_transform(parts, lambda x: [x]), lambda a, x: CASE WHEN x[1] = '..' THEN a[1:len(a) - 1] ELSE list_concat(a, x) END, CAST([] AS VARCHAR[])), '/')) AS file FROM r),
t AS (SELECT s.*, coalesce(e.trust_level, -9223372036854775807) AS trust, coalesce(epoch_us(ingested_at), -9223372036854775807) AS taken FROM s LEFT JOIN extractors e ON s.extractor = e.extractor),
g AS (SELECT *, min(rec_id) OVER (PARTITION BY file) AS group_id FROM t QUALIFY min(rec_id) OVER (PARTITION BY file) < max(rec_id) OVER (PARTITION BY file))
{" UNION ALL ".join(_winner(a) for a in ATTRIBUTES)}"""

P4_FOUND = f"""WITH t AS (SELECT 'text_docs' AS tbl, item_id, page_content AS text FROM text_docs UNION ALL SELECT 'store_rows', row_id, document FROM store_rows)
SELECT DISTINCT tbl, item_id, 'oversized' AS size_case FROM t WHERE length({_strip("text")}) > 1800
UNION ALL SELECT DISTINCT tbl, item_id, 'unbreakable' FROM t WHERE len(list_filter(regexp_extract_all(text, '{WORD}'), lambda w: length(w) > 1800)) > 0"""

P4_JOINED = f"""SELECT DISTINCT tbl, item_id, md5({_strip("text")}) AS digest, true AS fits FROM (SELECT 'text_docs' AS tbl, item_id, page_content AS text FROM text_docs UNION ALL SELECT 'store_rows', row_id, document FROM store_rows) WHERE {_strip("text")} <> ''"""

P7_FOUND = f"""WITH t AS (SELECT DISTINCT reading_id, 'caption' AS attr, caption AS text FROM image_readings UNION ALL SELECT DISTINCT reading_id, 'chartqa', chartqa FROM image_readings),
w AS (SELECT reading_id, attr, unnest(ws) AS word, generate_subscripts(ws, 1) AS i, len(ws) AS n FROM (SELECT reading_id, attr, regexp_extract_all(lower(text), '{WORD}') AS ws FROM t)),
g AS (SELECT *, CASE WHEN i <= n - 2 THEN word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o END AS run FROM w WINDOW o AS (PARTITION BY reading_id, attr ORDER BY i)),
r AS (SELECT *, run IS NOT NULL AND row_number() OVER (PARTITION BY reading_id, attr, run ORDER BY i) > 1 AS again FROM g),
c AS (SELECT reading_id, attr, n, again OR lag(again, 1, false) OVER o OR lag(again, 2, false) OVER o AS covered FROM r WINDOW o AS (PARTITION BY reading_id, attr ORDER BY i))
SELECT reading_id, attr FROM c GROUP BY reading_id, attr HAVING sum(CASE WHEN covered THEN 1 ELSE 0 END) >= 0.4 * any_value(n)"""


def _windows(tbl: str, key: str) -> str:
    return f"SELECT DISTINCT {key}, array_to_string(ws[i:i + 9], ' ') AS run FROM (SELECT {key}, ws, unnest(generate_series(1, len(ws) - 9)) AS i FROM (SELECT {key}, regexp_extract_all(lower(text), '{WORD}') AS ws FROM {tbl}) WHERE len(ws) >= 10)"


P9_FOUND = f"SELECT DISTINCT doc_id, item_id FROM ({_windows('documents', 'doc_id')}) d JOIN ({_windows('eval_items', 'item_id')}) e USING (run)"

P1_FOUND = f"""WITH t AS (SELECT DISTINCT 'store_rows' AS tbl, row_id AS id, document AS text FROM store_rows UNION ALL SELECT DISTINCT 'embed_payloads', payload_id * 1000 + p - 1, img_txt_docs[p] FROM (SELECT payload_id, img_txt_docs, unnest(generate_series(1, len(img_txt_docs))) AS p FROM embed_payloads)),
w AS (SELECT tbl, id, regexp_extract_all(lower(text), '{WORD}') AS ws FROM t),
r AS (SELECT DISTINCT tbl, id, array_to_string(ws[i:i + 2], ' ') AS run FROM (SELECT tbl, id, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM w WHERE len(ws) >= 3)),
n AS (SELECT tbl, id, count(*) AS n FROM r GROUP BY tbl, id),
p AS (SELECT a.tbl, a.id AS id_a, b.id AS id_b, count(*) AS shared FROM r a JOIN r b ON a.tbl = b.tbl AND a.run = b.run AND a.id < b.id GROUP BY 1, 2, 3)
SELECT p.tbl, id_a, id_b FROM p JOIN n x ON x.tbl = p.tbl AND x.id = id_a JOIN n y ON y.tbl = p.tbl AND y.id = id_b WHERE shared >= 0.6 * (x.n + y.n - shared)"""

P1_GROUPS = f"""WITH RECURSIVE t AS (SELECT DISTINCT 'store_rows' AS tbl, row_id AS id, document AS text FROM store_rows UNION ALL SELECT DISTINCT 'embed_payloads', payload_id * 1000 + p - 1, img_txt_docs[p] FROM (SELECT payload_id, img_txt_docs, unnest(generate_series(1, len(img_txt_docs))) AS p FROM embed_payloads)),
w AS (SELECT tbl, id, regexp_extract_all(lower(text), '{WORD}') AS ws FROM t),
r AS (SELECT DISTINCT tbl, id, array_to_string(ws[i:i + 4], ' ') AS run FROM (SELECT tbl, id, ws, unnest(generate_series(1, len(ws) - 4)) AS i FROM w WHERE len(ws) >= 5)),
n AS (SELECT tbl, id, count(*) AS n FROM r GROUP BY tbl, id),
p AS (SELECT a.tbl, a.id AS a, b.id AS b, count(*) AS shared FROM r a JOIN r b ON a.tbl = b.tbl AND a.run = b.run AND a.id < b.id GROUP BY 1, 2, 3),
l AS (SELECT p.tbl, a, b FROM p JOIN n x ON x.tbl = p.tbl AND x.id = a JOIN n y ON y.tbl = p.tbl AND y.id = b WHERE shared >= 0.8 * (x.n + y.n - shared)),
e AS (SELECT * FROM l UNION ALL SELECT tbl, b, a FROM l),
reach(tbl, id, m) AS (SELECT tbl, id, id FROM n UNION SELECT e.tbl, e.b, reach.m FROM reach JOIN e ON e.tbl = reach.tbl AND e.a = reach.id WHERE reach.m < e.b),
g AS (SELECT tbl, id AS key, min(m) AS group_id FROM reach GROUP BY tbl, id)
SELECT tbl, key, group_id, count(*) OVER (PARTITION BY tbl, group_id) AS n_members FROM g"""

P3_SURVIVORS = P3_FOUND[: P3_FOUND.index("g AS (")].rstrip().rstrip(",") + f""",
g AS (SELECT *, min(rec_id) OVER (PARTITION BY file) AS group_id FROM t)
SELECT group_id, {", ".join(f"max({a}) AS {a}" for a in ATTRIBUTES)} FROM (SELECT DISTINCT group_id, {", ".join(f"NULL::{'INTEGER' if a == 'page' else 'BOOLEAN' if a in ('caption', 'chartqa', 'ocr') else 'VARCHAR'} AS {a}" for a in ATTRIBUTES)} FROM g
{"".join(f" UNION ALL SELECT group_id, {', '.join(f'metadata.{a} AS {a}' if a == b else f'NULL AS {a}' for a in ATTRIBUTES)} FROM ({_best(b)})" for b in ATTRIBUTES)}) GROUP BY group_id"""

P7_SHARES = P7_FOUND[: P7_FOUND.index("SELECT reading_id, attr FROM c")] + """SELECT reading_id, attr, CAST(any_value(n) AS BIGINT) AS n_words, round(sum(CASE WHEN covered THEN 1 ELSE 0 END) / any_value(n), 6) AS repeated_share FROM c GROUP BY reading_id, attr
UNION ALL SELECT reading_id, attr, 0, 0.0 FROM (SELECT reading_id, attr, text FROM t) WHERE coalesce(len(regexp_extract_all(text, '""" + WORD + """')), 0) = 0"""

_VECTORS = """v AS (SELECT tbl, key, any_value(CAST(e AS DOUBLE[])) AS e FROM (SELECT 'store_rows' AS tbl, row_id AS key, embedding AS e FROM store_rows UNION ALL SELECT 'embed_payloads', payload_id * 1000 + p - 1, txt_embeddings[p] FROM (SELECT payload_id, txt_embeddings, unnest(generate_series(1, len(txt_embeddings))) AS p FROM embed_payloads))
WHERE len(e) = 64 AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0 GROUP BY tbl, key)"""


def _nearest(of: str, least: str) -> str:
    cosine = "round(list_cosine_similarity(a.e, b.e), 12)"
    return f"WITH {_VECTORS}, n AS (SELECT a.tbl, a.key, b.key AS other, {cosine} AS cos, row_number() OVER (PARTITION BY a.tbl, a.key ORDER BY {cosine} DESC, b.key) AS rank FROM v a JOIN v b ON a.tbl = b.tbl AND a.key <> b.key WHERE {of} AND {cosine} >= {least})"


P5_FOUND = _nearest("true", "0.85") + " SELECT DISTINCT tbl, least(key, other) AS id_a, greatest(key, other) AS id_b FROM n WHERE rank <= 10"
P5_NEAREST = _nearest("a.key % 100 = 0", "-1") + " SELECT tbl, key, CAST(rank AS INTEGER) AS rank, other, round(cos, 3) AS cos FROM n WHERE rank <= 10"

P8_ROUND_TRIP = "SELECT doc_id, coalesce(text, '') AS decoded FROM documents"

SQL = {"p4_joined": P4_JOINED, "p5_found": P5_FOUND, "p5_nearest": P5_NEAREST, "p7_shares": P7_SHARES, "p1_groups": P1_GROUPS, "p3_survivors": P3_SURVIVORS, "p1_found": P1_FOUND, "p3_found": P3_FOUND, "p4_found": P4_FOUND, "p7_found": P7_FOUND, "p8_round_trip": P8_ROUND_TRIP, "p9_found": P9_FOUND}
