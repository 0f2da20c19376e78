"""SQL for the operators that it can express, on the tables themselves."""

from __future__ import annotations

_WORDS = r"list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(8, len(w)) AS n, array_to_string(w[pos:pos + least(8, len(w)) - 1], ' ') AS phrase
       FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 7))) AS pos FROM i WHERE len(w) > 0)),
places AS (SELECT doc_id, n, pos, array_to_string(w[pos:pos + n - 1], ' ') AS phrase
           FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS pos FROM d, (SELECT DISTINCT n FROM iw))),
hits AS (SELECT doc_id, n, pos, item_id FROM places JOIN iw USING (n, phrase)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(generate_series(pos, pos + n - 1)) AS p FROM hits) GROUP BY doc_id),
owners AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id),
dw AS (SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS pos FROM d),
pw AS (SELECT phrase, n, unnest(string_split(phrase, ' ')) AS word, unnest(generate_series(0, n - 1)) AS off FROM (SELECT DISTINCT phrase, n FROM iw)),
nearby AS (SELECT DISTINCT doc_id, phrase FROM (SELECT doc_id, phrase, n, off, unnest([pos - off - 1, pos - off, pos - off + 1]) AS start FROM dw JOIN pw USING (word)) GROUP BY doc_id, phrase, n, start HAVING bit_or(1 << off) = (1 << n) - 1),
near_owners AS (SELECT doc_id, count(*) AS n_near, string_agg(item, ',' ORDER BY item) AS near FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM nearby JOIN iw USING (phrase)) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_items, 0) >= 2 AS contaminated, coalesce(n_near, 0) AS n_near, sha256(coalesce(near, '')) AS near_sha256
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN owners USING (doc_id) LEFT JOIN near_owners USING (doc_id)
"""

NEARDUP = f"""
WITH RECURSIVE t AS (SELECT text, min(doc_id) AS id FROM documents GROUP BY text),
w AS (SELECT id, {_WORDS} AS w FROM t),
s AS (SELECT DISTINCT id, hash(array_to_string(w[pos:pos + 4], ' ')) AS run FROM (SELECT id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS pos FROM w WHERE len(w) > 0)),
n AS (SELECT id, count(*) AS n FROM s GROUP BY id),
links AS (SELECT a, b FROM (SELECT x.id AS a, y.id AS b, count(*) AS common FROM s x JOIN s y ON x.run = y.run AND x.id <> y.id GROUP BY 1, 2) JOIN n p ON p.id = a JOIN n q ON q.id = b
          WHERE common >= 0.8 * (p.n + q.n - common)),
reach AS (SELECT id AS a, id AS b FROM t UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
root AS (SELECT a AS id, min(b) AS class_id FROM reach GROUP BY a),
found AS (SELECT documents.doc_id, class_id FROM documents JOIN t USING (text) JOIN root USING (id))
SELECT doc_id, class_id, count(*) OVER (PARTITION BY class_id) AS class_size FROM found
"""
