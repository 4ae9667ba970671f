"""DuckDB SQL for the corpus queries that SQL can express."""

from tidemark.llm.licences import AGREE, PHRASES, RARE, notice_rows

ORACLES: dict[str, str] = {}

LOWER = "translate({t}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = r"regexp_extract_all({t}, '[^\x20\x09-\x0D]+')"

ORACLES["op5_exact_dedup"] = f"""
WITH t AS (SELECT doc_id, {LOWER.format(t="coalesce(text, '')")} AS normal FROM documents),
g AS (SELECT normal, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY normal)
SELECT doc_id, CASE WHEN group_size > 1 THEN keep_id ELSE doc_id END AS keep_id, group_size,
       doc_id IS NOT DISTINCT FROM CASE WHEN group_size > 1 THEN keep_id ELSE doc_id END AS kept,
       sha256(normal) AS text_sha256
FROM t JOIN g USING (normal)
"""

MIX = f"""
sizes AS (
  SELECT doc_id, source, len({WORDS.format(t="coalesce(text, '')")})::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM {{docs}}),
ranked AS (
  SELECT source, sum(size)::BIGINT AS total,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM sizes GROUP BY source),
levels(level) AS (
  SELECT 0.0::DOUBLE
  UNION
  SELECT greatest(level, (SELECT (1.5::DOUBLE * sum(total)::DOUBLE
            - coalesce(sum(CASE WHEN 2 * total < level * weight THEN 2 * total END), 0)::DOUBLE)
          / sum(CASE WHEN NOT 2 * total < level * weight THEN weight END)::DOUBLE FROM ranked))
  FROM levels),
goals AS (
  SELECT source, total,
         CASE WHEN 2 * total < level * weight THEN (2 * total)::DOUBLE ELSE level * weight END AS target
  FROM ranked, (SELECT max(level) AS level FROM levels)),
plan AS (
  SELECT *, CASE WHEN total > 0 THEN floor(target / total)::BIGINT ELSE 0 END AS passes FROM goals),
ends AS (
  SELECT s.*, total, target, passes, target - passes * total AS rest,
         sum(size) OVER (PARTITION BY s.source ORDER BY h)::BIGINT AS e,
         sum(size) OVER (PARTITION BY s.source, h)::BIGINT AS own
  FROM sizes s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source),
cuts AS (
  SELECT doc_id, size, total AS source_size, target,
         passes + CASE WHEN total > 0 AND (e <= rest OR (e - own <= rest AND e - rest < rest - (e - own))) THEN 1 ELSE 0 END AS copies
  FROM ends)
"""
ORACLES["op3_mixing"] = f"""
WITH RECURSIVE {MIX.format(docs="documents")}
SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM cuts
"""

CLASS_PATTERNS = [r"\p{Ll}+", r"[\x20\x09-\x0D]+", r"\p{Lu}+", r"\p{N}+", r"[.,;:!?''\"()-]+"]


def quality_ctes(docs: str) -> str:
    """CTEs up to ``verdicts``: one row per document of ``docs`` (a table or CTE name)."""
    steps, left = [], "t"
    for k, pattern in enumerate(CLASS_PATTERNS):
        steps.append(f"regexp_replace({left}, '{pattern}', '', 'g') AS t{k + 1}")
        left = f"t{k + 1}"
    sizes = ", ".join(f"length({'t' if k == 0 else f't{k}'}) - length(t{k + 1})" for k in range(5)) + ", length(t5)"
    js = (
        "sqrt(greatest(list_sum(list_transform(list_zip({p}, {q}), lambda z: "
        "CASE WHEN z[1] > 0 THEN 0.5 * z[1] * log2(2 * z[1] / (z[1] + z[2])) ELSE 0 END + "
        "CASE WHEN z[2] > 0 THEN 0.5 * z[2] * log2(2 * z[2] / (z[1] + z[2])) ELSE 0 END)), 0))"
    )
    return f"""
raw AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS lang FROM {docs}),
split AS (SELECT *, {WORDS.format(t="t")} AS w, {", ".join(steps)} FROM raw),
classed AS (SELECT *, [x::DOUBLE FOR x IN [{sizes}]] AS cc FROM split),
class_sums AS (SELECT lang, [{", ".join(f"sum(cc[{k}])" for k in range(1, 7))}] AS s FROM classed GROUP BY lang),
class_ref AS (SELECT lang, list_transform(s, lambda v: v / greatest(list_sum(s), 1)) AS class_share FROM class_sums),
word_rows AS (SELECT rid, lang, unnest(list_transform(w, lambda x: lower(x))) AS word FROM split),
word_n AS (SELECT lang, word, count(*) AS n FROM word_rows GROUP BY ALL),
lang_n AS (SELECT lang, sum(len(w))::DOUBLE AS n FROM split GROUP BY lang),
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS r FROM word_n) WHERE r <= 24),
word_ref AS (
  SELECT lang, common, list_append(sh, 1 - list_sum(sh)) AS word_share
  FROM (SELECT top.lang, list(word ORDER BY r) AS common, list(top.n / lang_n.n ORDER BY r) AS sh
        FROM top JOIN lang_n USING (lang) GROUP BY top.lang)),
lines AS (
  SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM raw)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY rid),
windows AS (
  SELECT rid, i, array_to_string(w[i:i + 7], ' ') AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM split WHERE len(w) >= 8)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM windows) WHERE c > 1),
repeats AS (
  SELECT rid, sum(least(8, coalesce(d, 8))) AS n
  FROM (SELECT rid, lead(i) OVER (PARTITION BY rid ORDER BY i) - i AS d FROM twice) GROUP BY rid),
counted AS (
  SELECT s.rid, s.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(repeats.n, 0)::BIGINT AS n_repeat_words,
         length(t) AS chars,
         CASE WHEN length(t) >= 100 THEN round({js.format(p="list_transform(cc, lambda v: v / list_sum(cc))", q="class_share")}, 9)
              ELSE 0 END AS class_distance,
         list_transform(common, lambda c: len(list_filter(w, lambda x: lower(x) = c))::DOUBLE) AS hits, word_share
  FROM classed s JOIN class_ref USING (lang) LEFT JOIN word_ref USING (lang) LEFT JOIN lines USING (rid)
  LEFT JOIN repeats USING (rid)),
distances AS (
  SELECT * EXCLUDE (hits, word_share),
         CASE WHEN n_words >= 30 AND hits IS NOT NULL
              THEN round({js.format(p="list_transform(list_append(hits, n_words - list_sum(hits)), lambda v: v / n_words)", q="word_share")}, 9)
              ELSE 0 END AS word_distance,
         n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed
  FROM counted),
verdicts AS (
  SELECT *, NOT base_failed AND class_distance <= sqrt(0.09 + 10 / (8 * ln(2)) / greatest(chars, 1))
         AND word_distance <= sqrt(0.0625 + 48 / (8 * ln(2)) / greatest(n_words, 1)) AS kept
  FROM distances)
"""


ORACLES["op2_quality_rules"] = f"""
WITH {quality_ctes("documents")}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, class_distance, word_distance,
       base_failed, kept FROM verdicts
"""

ORACLES["op7_url_filter"] = r"""
WITH rules(host, path, verdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
parts AS (
  SELECT row_number() OVER () AS rid, page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
fits AS (
  SELECT p.rid, r.host || r.path AS rule, r.verdict,
         row_number() OVER (PARTITION BY p.rid ORDER BY length(r.host) + length(r.path) DESC, length(r.host) DESC) AS n
  FROM parts p JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE n = 1) USING (rid)
"""

ORACLES["op4_sharding"] = """
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n::BIGINT, [0::BIGINT FOR x IN range(8)]),
           lambda c, z: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END)) AS t),
rows AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, strlen(coalesce(text, ''))::BIGINT + 1 AS size
  FROM documents),
sums AS (
  SELECT rid, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
           list_transform(regexp_extract_all(h, '..'), lambda i: ('0x' || i)::BIGINT)),
           lambda c, b: xor(c // 256, t[(xor(c, b) & 255) + 1]))) AS text_crc32
  FROM (SELECT rid, text, hex(encode(text)) AS h FROM rows), crc),
ranked AS (SELECT *, min(doc_id) OVER (PARTITION BY text) AS first FROM rows),
groups AS (
  SELECT text, sum(size)::BIGINT AS size, sum(sum(size)) OVER (ORDER BY first, sha256(text))::BIGINT AS e
  FROM ranked GROUP BY text, first),
totals AS (SELECT sum(size)::BIGINT AS total, max(size)::BIGINT AS largest FROM groups),
ends AS (SELECT list(e ORDER BY e) AS l FROM groups),
tries AS (
  SELECT unnest(range(greatest(largest, (total + 15) // 16), greatest(largest, (total + 15) // 16) + largest + 1)) AS c
  FROM totals),
walk(c, j, p) AS (
  SELECT c, 0, 0::BIGINT FROM tries
  UNION ALL
  SELECT w.c, w.j + 1, coalesce(g.e, 0)
  FROM walk w ASOF LEFT JOIN groups g ON w.p + w.c >= g.e WHERE w.j < 16),
best AS MATERIALIZED (SELECT min(c) AS c FROM walk, totals WHERE j = 16 AND p = total),
cuts AS MATERIALIZED (SELECT j, p FROM walk WHERE c = (SELECT c FROM best) AND j BETWEEN 1 AND 15),
sharded AS (
  SELECT r.rid, r.doc_id, r.size, r.first, r.text,
         (SELECT count(*) FROM cuts WHERE cuts.p <= g.e - g.size)::INT AS shard
  FROM ranked r JOIN groups g USING (text))
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY first, sha256(text), doc_id) - 1 AS slot,
       NULL::INT AS grown_shard
FROM sharded JOIN sums USING (rid)
"""

ORACLES["op13_source_audit"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents),
words AS (SELECT rid, lang, source, unnest(words) AS term FROM docs),
kept AS (SELECT lang, term FROM (SELECT DISTINCT rid, lang, term FROM words) GROUP BY ALL HAVING count(*) >= 3),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
grps AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS total FROM grps g LEFT JOIN counts USING (lang, source) GROUP BY ALL),
shares AS MATERIALIZED (
  SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n,
         (1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (t.total + v))::HUGEINT AS p
  FROM totals t JOIN sizes USING (lang) JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)),
langs AS (
  SELECT lang, term, (1 + (1000000000::HUGEINT * (sum(n) + 1)) // (sum(sum(n)) OVER (PARTITION BY lang) + any_value(v)))::HUGEINT AS q
  FROM shares JOIN sizes USING (lang) GROUP BY lang, term),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p)::BIGINT AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
  UNION ALL
  SELECT a.lang, a.source, 'pair', b.source, 0 FROM grps a JOIN grps b ON a.lang = b.lang AND a.source <> b.source
  WHERE a.lang NOT IN (SELECT lang FROM sizes)),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, (((p - q) * (p - q)) // q)::BIGINT AS value
  FROM shares JOIN langs USING (lang, term) WHERE n > 0 AND p > q)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank
FROM (FROM pairs UNION ALL FROM terms) QUALIFY part = 'pair' OR rank <= 200
"""

ORACLES["op12_hard_negatives"] = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id, list_inner_product(a.v, r.v)::BIGINT AS s
  FROM rows a JOIN rows r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, s AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, s AS negative_score,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s DESC, vec_id))::INT AS rank
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * s AND 100 * s <= 90 * positive_score
QUALIFY rank <= 10
"""


def licence_sql() -> str:
    """Relational form: words of notices and files as rows, offsets grouped."""
    rows, keys = [], []
    for t, n in enumerate(notice_rows()):
        rows += [f"({t}, '{n['label']}', {p}, '{x}')" for p, x in enumerate(n["words"])]
        keys += [f"({t}, {k['at'] + i})" for k in n["keys"] for i in range(len(k["words"]))]
    phrases = []
    for phrase, label in PHRASES:
        x = phrase.split()
        test = " AND ".join(f"w[i + {k}] = '{word}'" for k, word in enumerate(x))
        phrases.append(f"SELECT rid, '{label}' AS label, i - 1 AS place FROM spots WHERE {test}")
    return rf"""
WITH notices(t, label, p, x) AS (VALUES {", ".join(rows)}),
keyed(t, p) AS (SELECT DISTINCT * FROM (VALUES {", ".join(keys)})),
docs AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all({LOWER.format(t="coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
spots AS (SELECT rid, w, unnest(range(1, len(w) + 1)) AS i FROM docs WHERE list_contains(w, 'license')),
base AS ({" UNION ALL ".join(phrases)}),
found AS (SELECT rid, unnest(w) AS x, unnest(range(len(w))) AS i FROM docs),
marks AS (FROM found WHERE x IN (SELECT x FROM notices)),
counts AS (SELECT x, count(DISTINCT rid) AS n FROM marks GROUP BY x),
rare AS (
  SELECT rid, t, x FROM (SELECT DISTINCT rid, t, x FROM marks JOIN notices USING (x)) JOIN counts USING (x)
  QUALIFY row_number() OVER (PARTITION BY rid, t ORDER BY n, x) <= {RARE}),
offs AS (
  SELECT rid, t, m.i - n.p AS o FROM marks m JOIN rare USING (rid, x) JOIN notices n USING (t, x)
  GROUP BY ALL HAVING count(*) >= {AGREE}),
compared AS (
  SELECT o.rid, o.t, o.o, any_value(n.label) AS label, count(*) AS length, count(m.i) AS matched,
         count(k.p) AS needed, count(CASE WHEN m.i IS NOT NULL THEN k.p END) AS standing
  FROM offs o JOIN notices n USING (t) LEFT JOIN marks m ON m.rid = o.rid AND m.x = n.x AND m.i = o.o + n.p
  LEFT JOIN keyed k ON k.t = n.t AND k.p = n.p GROUP BY ALL),
noticed AS (FROM compared WHERE needed = standing),
by_base AS (
  SELECT rid, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY rid),
by_all AS (
  SELECT rid, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT rid, label FROM base UNION ALL SELECT rid, label FROM noticed) GROUP BY rid),
scores AS (SELECT rid, round(max(matched / length), 9) AS score FROM noticed GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0)::DOUBLE AS score
FROM docs LEFT JOIN by_base USING (rid) LEFT JOIN by_all USING (rid) LEFT JOIN scores USING (rid)
"""


ORACLES["op11_licence_scan"] = licence_sql()
