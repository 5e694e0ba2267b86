"""SQL twins of the queries that SQL can express, written for DuckDB."""

import re

from cropmosaic.llm.licenses import TEMPLATES

_UNIT = "cast(('0x' || substr(md5({0}), 1, 12)) AS BIGINT)::DOUBLE / 281474976710656.0"

_MIX = f"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         {_UNIT.format("'mix|' || coalesce(doc_id::VARCHAR, '')")} AS u
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rk FROM d GROUP BY source),
w AS (SELECT source, source_size, rk, 1.0::DOUBLE + (rk - 1) % 3 AS weight, 3.0::DOUBLE * source_size AS cap FROM s),
o AS (
  SELECT *, row_number() OVER (ORDER BY cap / weight, rk) AS n,
         (sum(source_size) OVER ())::DOUBLE
           - coalesce(sum(cap) OVER (ORDER BY cap / weight, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
         sum(weight) OVER (ORDER BY cap / weight, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS onward
  FROM w),
level AS (SELECT arg_min(rest / onward, n) AS level FROM o WHERE rest / onward <= cap / weight),
t AS (SELECT source, source_size, least(cap, coalesce(level * weight, cap)) AS target FROM w, level),
p AS (
  SELECT d.*, t.source_size, t.target, round(t.target)::BIGINT AS budget,
         coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY u, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
e AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs FROM p)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, budget - epochs * source_size - before)))::BIGINT AS taken
FROM e
"""

_SCORE = "-1.0 / ln(" + _UNIT.format("'shard|' || coalesce(doc_id::VARCHAR, '') || '|' || s::VARCHAR") + " + pow(2.0, -49))"

_SHARD = f"""
WITH crc AS (
  SELECT list(list_reduce(range(0, 8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, n) ORDER BY n) AS tbl
  FROM (SELECT unnest(range(0, 256))::BIGINT AS n)),
sums AS (
  SELECT body, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(body)), '..'), lambda h: ('0x' || h)::BIGINT),
                               lambda c, b: xor(c // 256, tbl[xor(c % 256, b) + 1]), 4294967295::BIGINT), 4294967295) AS text_crc32
  FROM (SELECT DISTINCT coalesce(text, '') AS body FROM documents), crc),
d AS (
  SELECT doc_id, (strlen(coalesce(text, '')) + 16)::BIGINT AS size, coalesce(text, '') AS body,
         {_UNIT.format("'slot|' || coalesce(doc_id::VARCHAR, '')")} AS u
  FROM documents),
keys AS (SELECT DISTINCT doc_id FROM d),
scores AS (SELECT doc_id, s, {_SCORE} AS score FROM keys, range(0, 41) r(s)),
best AS (
  SELECT doc_id, arg_max(s, struct_pack(a := score, b := -s)) FILTER (s < 40) AS shard,
         arg_max(s, struct_pack(a := score, b := -s)) AS grown FROM scores GROUP BY doc_id)
SELECT d.doc_id, size, text_crc32::BIGINT AS text_crc32, 'key' AS law, shard::INT AS shard,
       (row_number() OVER (PARTITION BY shard ORDER BY u, d.doc_id, size) - 1)::BIGINT AS slot, grown::INT AS grown_shard
FROM d JOIN best ON d.doc_id IS NOT DISTINCT FROM best.doc_id JOIN sums USING (body)
"""

_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_DECONTAMINATION = f"""
WITH i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
phrases AS (
  SELECT item_id, least(len(w), 10) AS k, array_to_string(w[p : p + 9], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS p FROM i WHERE len(w) > 0)),
d AS (SELECT doc_id, row_number() OVER () AS n, {_WORDS} AS w FROM documents),
runs AS (
  SELECT n, p, k, array_to_string(w[p : p + k - 1], ' ') AS phrase
  FROM (SELECT n, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM phrases) WHERE len(w) >= k)),
hits AS (SELECT n, p, runs.k, item_id FROM runs JOIN phrases USING (phrase, k)),
words AS (SELECT n, count(DISTINCT p + j) AS n_hit FROM (SELECT DISTINCT n, p, k FROM hits), range(0, 10) r(j) WHERE j < k GROUP BY n),
items AS (
  SELECT n, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT n, item_id::VARCHAR AS item_id FROM hits) GROUP BY n)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (n) LEFT JOIN items USING (n)
"""

_B32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((cast(('0x' || substr(h, {5 * g + 1}, 5)) AS BIGINT) >> {s}) & 31)::INT + 1, 1)"
    for g in range(8)
    for s in (15, 10, 5, 0)
)

_WARC = f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
m AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
SELECT page_id, payload_bytes, {_B32} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM p JOIN m USING (h)
"""

_CRC = """crc AS (
  SELECT list(list_reduce(range(0, 8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, n) ORDER BY n) AS tbl
  FROM (SELECT unnest(range(0, 256))::BIGINT AS n))"""

_IMPORTANCE = f"""
WITH {_CRC},
d AS (SELECT row_number() OVER () AS n, doc_id, {_WORDS} AS w FROM documents),
a AS (SELECT n, w FROM d UNION ALL SELECT -row_number() OVER (), {_WORDS} FROM benchmark),
f AS (SELECT n, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS feature FROM a),
h AS (
  SELECT feature, xor(list_reduce(list_transform(regexp_extract_all(hex(encode(feature)), '..'), lambda h: ('0x' || h)::BIGINT),
                                  lambda c, b: xor(c // 256, tbl[xor(c % 256, b) + 1]), 4294967295::BIGINT), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT feature FROM f), crc),
b AS (SELECT n, bucket FROM f JOIN h USING (feature)),
c AS (SELECT bucket, count(*) FILTER (n > 0) AS s, count(*) FILTER (n < 0) AS t FROM b GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((sum(s) OVER ()) + 10000) / ((s + 1)::DOUBLE * ((sum(t) OVER ()) + 10000))))::BIGINT AS gain
  FROM c),
w AS (SELECT n, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM b JOIN gains USING (bucket) WHERE n > 0 GROUP BY n),
scored AS (
  SELECT n, doc_id, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         (coalesce(weight, 0) + floor(-1000 * ln(-ln((cast(('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8)) AS BIGINT) + 0.5::DOUBLE)
                                                      / 4294967296))))::BIGINT AS score
  FROM d LEFT JOIN w USING (n)),
ranked AS (
  SELECT n, row_number() OVER (ORDER BY score DESC, doc_id, n_features) AS rank, count(*) OVER () AS able FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= able * 25 // 100 THEN rank END::BIGINT AS rank
FROM scored LEFT JOIN ranked USING (n)
"""


def _pattern(markup: str) -> str:
    """The template as a pattern over words that each end in a blank."""
    out = []
    for part in re.split("(<<.*?>>)", markup):
        if part == "<<beginOptional>>":
            out.append("(?:")
        elif part == "<<endOptional>>":
            out.append(")?")
        elif part.startswith("<<var"):
            out.append("(?:[^ ]+ ){%s,%s}" % tuple(re.findall("[0-9]+", part)))
        else:
            out += [w + " " for w in re.findall("[a-z0-9]+", part.lower())]
    return "^" + "".join(out)


def _most_words(markup: str) -> int:
    wild = sum(int(n) for n in re.findall("-([0-9]+)>>", markup))
    return wild + len(re.findall("[a-z0-9]+", re.sub("<<.*?>>", " ", markup).lower()))


_TEMPLATES = ",\n  ".join(
    "('{}', {}, '{}', {}, '{}')".format(t.label, t.base, re.findall("[a-z]+", t.markup.lower())[0], _most_words(t.markup), _pattern(t.markup))
    for t in TEMPLATES
)

_LICENSES = f"""
WITH d AS (SELECT row_number() OVER () AS n, doc_id, {_WORDS} AS w FROM documents),
t(label, base, first, most, pattern) AS (VALUES
  {_TEMPLATES}),
starts AS (
  SELECT n, w, label, base, most, pattern, unnest(list_filter(range(1, len(w) + 1), lambda i: w[i] = first)) AS p
  FROM d, t WHERE list_contains(w, first)),
found AS (
  SELECT n, label, base, p, regexp_extract(array_to_string(w[p : p + most - 1], ' ') || ' ', pattern) AS m FROM starts),
spans AS (SELECT n, label, base, p, len(m) - len(replace(m, ' ', '')) AS k FROM found WHERE m <> ''),
sums AS (
  SELECT n, count(*) FILTER (base) AS n_base, min(p) FILTER (base) - 1 AS first_word, max(p) FILTER (base) - 1 AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM spans GROUP BY n),
inside AS (SELECT n, count(DISTINCT p + j) AS c FROM spans, range(0, 1000) r(j) WHERE j < k GROUP BY n)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CASE WHEN c > 0 THEN c::DOUBLE / len(w) ELSE 0.0::DOUBLE END AS score
FROM d LEFT JOIN sums USING (n) LEFT JOIN inside USING (n)
"""

_DIVERGENCE = """
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
t AS (SELECT id, lang, source, unnest(w) AS term FROM d),
c AS (SELECT lang, source, term, count(*) AS n, count(DISTINCT id) AS docs FROM t GROUP BY ALL),
k AS (SELECT lang, term, sum(n) AS total FROM c GROUP BY ALL HAVING sum(docs) >= 30),
g AS (SELECT DISTINCT lang, source FROM d),
m AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, total FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
p AS (
  SELECT lang, source, term, n,
         1 + (1000000000::HUGEINT * (n + 5)) // ((sum(n) OVER w) + 5 * (count(*) OVER w)) AS p,
         1 + (1000000000::HUGEINT * (total + 5)) // ((sum(total) OVER w) + 5 * (count(*) OVER w)) AS q
  FROM m WINDOW w AS (PARTITION BY lang, source)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum(abs(x.p - y.p)), 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY ALL),
both_parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM both_parts)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""

ORACLE = {
    "op3_mixing": _MIX,
    "op7_warc": _WARC,
    "op8_sharding": _SHARD,
    "op9_decontamination": _DECONTAMINATION,
    "op11_importance": _IMPORTANCE,
    "op12_licenses": _LICENSES,
    "op13_divergence": _DIVERGENCE,
}
