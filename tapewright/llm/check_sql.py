"""DuckDB SQL for the operators of this subpackage that SQL can express."""

from __future__ import annotations

from tapewright.llm import hard_negatives, mixing, quality, spelling, url_trust

_WORD = r"[^\x20\x09-\x0D]+"
_BLANK = r"[\x20\x09-\x0D]"


def mix() -> str:
    weights = ", ".join(map(str, mixing.WEIGHTS))
    return rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS size,
         coalesce(('0x' || substr(md5(doc_id::VARCHAR), 1, 15))::BIGINT, 0) AS place
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS no
  FROM sized GROUP BY source),
capped AS (
  SELECT *, [{weights}][no % {len(mixing.WEIGHTS)} + 1] AS weight, source_size * {mixing.MAX_COPIES} AS cap,
         sum(source_size) OVER () * {mixing.BUDGET_PERCENT} / 100 AS budget
  FROM sources),
levels AS (
  SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap / weight, no
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY cap / weight, no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM capped),
targets AS (
  SELECT *, coalesce(least(weight * max(level) FILTER (level * weight <= cap) OVER (), cap::DOUBLE),
                     cap::DOUBLE) AS target
  FROM levels),
queued AS (
  SELECT s.*, t.source_size, t.target, t.no, t.weight, t.budget,
         sum(size) OVER (PARTITION BY t.no ORDER BY place, doc_id ROWS UNBOUNDED PRECEDING) AS total
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
entries AS (
  SELECT *, (copy * source_size + total) / weight AS finish
  FROM queued, (SELECT unnest(range({mixing.MAX_COPIES})) AS copy)),
run AS (
  SELECT *, sum(size) OVER (ORDER BY finish, no, place, doc_id, copy ROWS UNBOUNDED PRECEDING) <= budget AS taken_in
  FROM entries)
SELECT doc_id, size::BIGINT AS size, source_size, target, (count_if(taken_in) * size)::BIGINT AS taken, source,
       count_if(taken_in)::BIGINT AS copies
FROM run GROUP BY doc_id, size, source_size, target, source"""


def quality_rules() -> str:
    grams = (quality.REPEAT_WORDS, *quality.NGRAM_LIMITS)
    spans = ",\n         ".join(
        f"CASE WHEN lead(i, {n - 1}) OVER ahead IS NOT NULL THEN string_agg(word, ' ') OVER "
        f"(PARTITION BY doc ORDER BY i ROWS BETWEEN CURRENT ROW AND {n - 1} FOLLOWING) END AS g{n}" for n in grams)
    twice = ", ".join(f"(g{n} IS NOT NULL AND count(*) OVER (PARTITION BY doc, g{n}) > 1)::INT AS t{n}" for n in grams)
    cover = ", ".join(f"max(t{n}) OVER (PARTITION BY doc ORDER BY i ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW) AS c{n}"
                      for n in grams)
    chars = ", ".join(f"sum(c{n} * length(word))::BIGINT AS dup_{n}gram_chars" for n in quality.NGRAM_LIMITS)
    zeros = ", ".join(f"coalesce(dup_{n}gram_chars, 0) AS dup_{n}gram_chars" for n in quality.NGRAM_LIMITS)
    within = " AND ".join(f"dup_{n}gram_chars <= {limit}::DOUBLE * word_chars" for n, limit in quality.NGRAM_LIMITS.items())
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS doc, doc_id, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT doc, unnest(w) AS word, generate_subscripts(w, 1) AS i
  FROM (SELECT doc, regexp_extract_all(text, '{_WORD}') AS w FROM docs)),
spans AS (
  SELECT *, {spans}
  FROM words WINDOW ahead AS (PARTITION BY doc ORDER BY i)),
twice AS (SELECT *, {twice} FROM spans),
cover AS (SELECT *, {cover} FROM twice),
repeats AS (
  SELECT doc, count(*) AS n_words, sum(c{quality.REPEAT_WORDS})::BIGINT AS n_repeat_words, {chars}
  FROM cover GROUP BY doc),
lines AS (
  SELECT doc, unnest(l) AS line, generate_subscripts(l, 1) AS i
  FROM (SELECT doc, string_split(text, chr(10)) AS l FROM docs)),
later AS (
  SELECT doc, line, row_number() OVER (PARTITION BY doc, line ORDER BY i) > 1 AS again
  FROM lines WHERE regexp_matches(line, '{_WORD}')),
copies AS (
  SELECT doc, count(*) AS n_dup_lines, sum(length(regexp_replace(line, '{_BLANK}', '', 'g')))::BIGINT AS dup_line_chars
  FROM later WHERE again GROUP BY doc),
counted AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, length(regexp_replace(text, '{_BLANK}', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(dup_line_chars, 0) AS dup_line_chars, {zeros}
  FROM docs LEFT JOIN repeats USING (doc) LEFT JOIN copies USING (doc)),
based AS (
  SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.REPEAT_PERCENT} * n_words AS base_failed
  FROM counted)
SELECT *, NOT base_failed AND dup_line_chars <= {quality.LINE_LIMIT}::DOUBLE * word_chars AND {within} AS kept
FROM based"""


def _host(url: str) -> str:
    return (rf"translate(regexp_extract(coalesce({url}, ''), '(?s)^.*?://([^/?#]*)', 1), "
            "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")


def url_filter() -> str:
    ordered = sorted(url_trust.RULES, key=lambda r: -len(r[1] + r[2]))

    def case(of: int | None) -> str:
        return "CASE " + " ".join(
            f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') "
            f"THEN '{v if of == 0 else h + p}'" for v, h, p in ordered) + " END"
    d, last = url_trust.DAMPING, url_trust.rounds_for()
    rounds = "".join(f"""
state{k + 1} AS MATERIALIZED (
  SELECT host, good, bad, no_out, no_in,
         {1 - d} * good + {d} * (coalesce(t, 0) + CASE WHEN no_out THEN trust ELSE 0 END) AS trust,
         {1 - d} * bad + {d} * (coalesce(d, 0) + CASE WHEN no_in THEN distrust ELSE 0 END) AS distrust
  FROM state{k}
  LEFT JOIN (SELECT dst AS host, sum(trust * ahead) AS t FROM shares JOIN state{k} ON src = host GROUP BY dst) USING (host)
  LEFT JOIN (SELECT src AS host, sum(distrust * back) AS d FROM shares JOIN state{k} ON dst = host GROUP BY src) USING (host)
),""" for k in range(last))
    return rf"""
WITH cut AS (
  SELECT page_id, {_host('url')} AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM pages),
ruled AS MATERIALIZED (SELECT *, {case(1)} AS rule, {case(0)} AS ruled FROM cut),
counted AS (
  SELECT host, count(*) AS pages, count_if(ruled = 'allow') AS good, count_if(ruled = 'block') AS bad
  FROM ruled GROUP BY host),
total AS (SELECT sum(pages) AS pages, greatest(sum(good), 1) AS good, greatest(sum(bad), 1) AS bad FROM counted),
links AS (
  SELECT {_host('url')} AS src, unnest(regexp_extract_all(html,
    '(?i)href\s*=\s*["'']?((?:[a-z][a-z0-9+.-]*:)?//[^"''>\s]*)', 1)) AS link FROM pages),
edges AS MATERIALIZED (
  SELECT src, dst, count(*) AS w
  FROM (SELECT src, {_host("CASE WHEN starts_with(link, '//') THEN 'http:' || link ELSE link END")} AS dst FROM links)
  WHERE src <> '' AND dst <> '' AND src <> dst GROUP BY src, dst),
shares AS MATERIALIZED (
  SELECT src, dst, w / sum(w) OVER (PARTITION BY src) AS ahead, w / sum(w) OVER (PARTITION BY dst) AS back FROM edges),
seeds AS (
  SELECT host, c.good / t.good AS good, c.bad / t.bad AS bad FROM counted c, total t WHERE host <> ''),
hosts AS (
  SELECT host, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad,
         host NOT IN (SELECT src FROM edges) AS no_out, host NOT IN (SELECT dst FROM edges) AS no_in
  FROM seeds FULL JOIN (SELECT src AS host FROM edges UNION SELECT dst FROM edges) USING (host)),
state0 AS MATERIALIZED (SELECT *, good AS trust, bad AS distrust FROM hosts),{rounds}
scored AS (SELECT host, round(trust, 9) AS trust, round(distrust, 9) AS distrust FROM state{last}),
judged AS (
  SELECT c.host, s.trust, s.distrust,
         CASE WHEN s.distrust > s.trust AND s.distrust * (1 - c.pages / t.pages)
                   >= {url_trust.BLOCK_LIFT}::DOUBLE * (c.pages / t.pages) * (1 - s.distrust)
              THEN 'block' ELSE 'allow' END AS by_host
  FROM counted c CROSS JOIN total t LEFT JOIN scored s USING (host))
SELECT page_id, r.host, path, rule, coalesce(ruled, by_host, 'allow') AS verdict,
       coalesce(trust, 0) AS trust, coalesce(distrust, 0) AS distrust
FROM ruled r LEFT JOIN judged USING (host)"""


def exact_dedup() -> str:
    return """
WITH norm AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents),
same AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM norm GROUP BY norm)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM norm JOIN same USING (norm)"""


def spelling_variants() -> str:
    """Near words by a path of its own: deleting one letter of each word, and joining what is left."""
    return rf"""
WITH RECURSIVE bits(i, k, c) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS v FROM bits WHERE k = 8),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
counted AS (
  SELECT doc_id, run, count(*) AS n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS x
  FROM runs WHERE length(run) >= {spelling.LEAST_LETTERS} GROUP BY doc_id, run),
hashed AS (
  SELECT run, n, xor(list_reduce(
           list_transform(range(0, length(x) // 2), lambda b: ('0x' || substr(x, 2 * b + 1, 2))::BIGINT),
           lambda h, b: xor(h >> 8, v[(xor(h, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS h
  FROM counted, crc),
slipped AS (
  SELECT CASE WHEN h % {spelling.SLIP} = 0
              THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
  FROM hashed),
words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= {spelling.LEAST_LETTERS}
  GROUP BY word HAVING sum(n) >= {spelling.LEAST_COUNT}),
cut AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT c.word, w.word, w.n FROM cut c JOIN words w ON c.rest = w.word
  UNION
  SELECT w.word, c.word, c.n FROM cut c JOIN words w ON c.rest = w.word),
best AS (
  SELECT word, count(*) AS n_near, max(other_n) AS best_n,
         first(other ORDER BY other_n DESC, encode(other)) AS best FROM near GROUP BY word),
forms AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN best_n >= {spelling.FORM_LIFT} * n THEN best END AS form,
         CASE WHEN best_n >= {spelling.FORM_LIFT} * n THEN best_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS root FROM forms
  UNION
  SELECT c.word, f.form FROM chain c JOIN forms f ON c.root = f.word WHERE f.form IS NOT NULL),
roots AS (
  SELECT c.word, c.root FROM chain c JOIN forms f ON c.root = f.word WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)"""


def hard_negatives_mined() -> str:
    return f"""
WITH usable AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % {hard_negatives.RELABEL_STEP} = 0
           THEN (label + 1) % {hard_negatives.LABELS} ELSE label END AS label,
         list_transform(embedding, lambda x: floor({hard_negatives.SCALE} * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         list_inner_product(a.q, b.q)::BIGINT AS score
  FROM usable a JOIN usable b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
  WHERE a.vec_id % {hard_negatives.ANCHOR_STEP} = 0),
positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {hard_negatives.POSITIVES})
SELECT p.anchor_id, p.vec_id AS positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)::INTEGER AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
 AND {hard_negatives.LOW_PERCENT} * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= {hard_negatives.NEGATIVES}"""
