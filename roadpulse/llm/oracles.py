"""SQL for an independent engine, for the operators that SQL can express."""

from __future__ import annotations

from roadpulse.llm import licenses, near, quality_rules, repeats

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: crc32 of the text column ``s`` of relation ``strings``, as relation crc(s, h).
_CRC = r"""
crc_table AS (
  SELECT list(list_reduce(range(0, 8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i)
              ORDER BY i) AS t
  FROM range(256) r(i)),
crc AS (
  SELECT s, xor(list_reduce(
      list_transform(range(1, length(hex(s)) // 2 + 1), lambda k: ('0x' || substr(hex(s), (2 * k - 1)::INT, 2))::BIGINT),
      lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1]), 4294967295), 4294967295) AS h
  FROM strings, crc_table)"""


def quality_rules_sql() -> str:
    bins = quality_rules.BINS
    return rf"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
marked AS (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL
           GROUP BY doc_id HAVING min(quality) = 1),
spot AS (SELECT r, doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM words),
strings AS (SELECT DISTINCT w[i] AS s FROM spot),{_CRC},
ids AS (SELECT r, doc_id, i, h, lead(h) OVER (PARTITION BY r ORDER BY i) AS after FROM spot JOIN crc ON s = w[i]),
grams AS (
  SELECT r, doc_id, h % {bins} AS bin FROM ids
  UNION ALL SELECT r, doc_id, (h * 31 + after) % {bins} FROM ids WHERE after IS NOT NULL),
counts AS (
  SELECT bin, count(*) AS raw, count(t.doc_id) AS good
  FROM grams g LEFT JOIN marked t ON g.doc_id = t.doc_id GROUP BY bin),
weights AS (
  SELECT bin, round(1e6 * (ln((good + 1) / ((SELECT sum(good) FROM counts) + {bins}))
                         - ln((raw + 1) / ((SELECT sum(raw) FROM counts) + {bins}))))::BIGINT AS weight
  FROM counts),
ratios AS (SELECT r, sum(weight)::BIGINT AS ratio FROM grams JOIN weights USING (bin) GROUP BY r),
windows AS (
  SELECT r, i, count(*) OVER (PARTITION BY r, w[i:i + 4]) AS k FROM spot WHERE i + 4 <= len(w)),
covered AS (SELECT r, count(DISTINCT i + d) AS n FROM windows, range(5) t(d) WHERE k > 1 GROUP BY r),
lines AS (
  SELECT r, count(*) - count(DISTINCT line) AS n
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM words)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
base AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         coalesce(l.n, 0)::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         coalesce(ratio, 0)::BIGINT AS log_ratio_millionths
  FROM words LEFT JOIN lines l USING (r) LEFT JOIN covered c USING (r) LEFT JOIN ratios USING (r))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT base_failed AND log_ratio_millionths >= {quality_rules.THRESHOLD} * greatest(2 * n_words - 1, 1) AS kept
FROM base"""


def license_scan_sql() -> str:
    notices = ",\n  ".join(
        f"({n}, '{label}', '{notice}', {phrases!r})" for n, (label, notice, phrases) in enumerate(licenses.NOTICES)
    )
    common = ", ".join(f"'{w}'" for w in licenses.COMMON)
    base = ", ".join(f"('{phrase}', '{label}')" for phrase, label in licenses.BASE.items())
    return rf"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
notices(notice, label, body, phrases) AS (VALUES
  {notices}),
postings AS (
  SELECT * FROM (SELECT notice, label, phrases, p[i] AS word, i - 1 AS place
                 FROM (SELECT *, string_split(body, ' ') AS p FROM notices), range(1, 1 + {max(len(n.split()) for _, n, _ in licenses.NOTICES)}) t(i) WHERE i <= len(p))
  WHERE word NOT IN ({common})),
spot AS (SELECT r, w[i] AS word, i - 1 AS spot
       FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM words) WHERE w[i] IN (SELECT word FROM postings)),
frequency AS (SELECT word, count(DISTINCT r) AS n FROM spot GROUP BY word),
asked AS (
  SELECT r, notice, word, row_number() OVER (PARTITION BY r, notice ORDER BY n, word) AS k
  FROM (SELECT DISTINCT r, word FROM spot) JOIN frequency USING (word)
  JOIN (SELECT DISTINCT notice, word FROM postings) USING (word)),
top AS (SELECT r, notice, word FROM asked WHERE k <= {licenses.LOOKUPS}),
n_top AS (SELECT r, notice, count(*) AS asked FROM top GROUP BY ALL),
confirmed AS (
  SELECT r, notice FROM words, notices
  WHERE list_bool_and(list_transform(phrases, lambda p: contains(' ' || array_to_string(w, ' ') || ' ', ' ' || p || ' ')))),
hits AS (
  SELECT r, notice, label, spot - place AS shift, count(DISTINCT word) AS hits
  FROM spot JOIN postings USING (word) JOIN confirmed USING (r, notice) JOIN top USING (r, notice, word)
  GROUP BY ALL),
found AS (
  SELECT r, list(DISTINCT label) AS labels, max(hits / asked) AS share
  FROM hits JOIN n_top USING (r, notice) WHERE hits >= least({licenses.IN_LINE}, asked) GROUP BY r),
base(phrase, label) AS (VALUES {base}),
places AS (
  SELECT r, label, i - 1 AS spot
  FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM words), (SELECT *, string_split(phrase, ' ') AS p FROM base)
  WHERE w[i:i + len(p) - 1] = p),
based AS (
  SELECT r, count(*) AS n, min(spot) AS first_word, max(spot) AS last_word, list(DISTINCT label) AS labels
  FROM places GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(b.labels, f.labels))), ','), '') AS labels,
       greatest(CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END, coalesce(share, 0.0::DOUBLE)) AS score
FROM words LEFT JOIN based b USING (r) LEFT JOIN found f USING (r)"""


def near_duplicates_sql(percent: int = 85) -> str:
    size = near.SHINGLE
    return rf"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT r, doc_id, w[i:i + {size - 1}] AS s
  FROM (SELECT r, doc_id, w, unnest(range(1, greatest(len(w) - {size - 2}, 2))) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * k >= {percent} * (x.n + y.n - k)),
linked AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT doc_id, doc_id AS other FROM words
  UNION SELECT reach.doc_id, linked.b FROM reach JOIN linked ON reach.other = linked.a),
component AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM words JOIN component USING (doc_id) LEFT JOIN sizes USING (doc_id)"""


def repeats_sql(size: int = 400) -> str:
    return f"""
WITH bytes AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (
  SELECT r, i, md5(substr(h, 2 * i + 1, {2 * size})) AS m
  FROM (SELECT r, h, unnest(range(0, length(h) // 2 - {size - 1})) AS i FROM bytes WHERE length(h) >= {2 * size})),
again AS (SELECT r, i FROM windows SEMI JOIN (SELECT m FROM windows GROUP BY m HAVING count(*) > 1) USING (m)),
cuts AS (SELECT r, i, i - lag(i) OVER (PARTITION BY r ORDER BY i) > {size} AS gap FROM again),
runs AS (SELECT r, i, sum(CASE WHEN gap IS NULL OR gap THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY i) AS run FROM cuts),
spans AS (SELECT r, min(i) AS a, max(i) + {size} AS b FROM runs GROUP BY r, run),
edges AS (
  SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before,
         lead(a) OVER (PARTITION BY r ORDER BY a) AS after FROM spans),
kept AS (
  SELECT r, count(*) AS n, sum(b - a) AS removed,
         string_agg(substr(h, 2 * before + 1, 2 * (a - before)) || CASE WHEN after IS NULL THEN substr(h, 2 * b + 1) ELSE '' END,
                    '' ORDER BY a) AS rest
  FROM edges JOIN bytes USING (r) GROUP BY r)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed,
       coalesce(n, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(rest, h))) AS kept_sha256
FROM bytes LEFT JOIN kept USING (r)"""


def filter_audit_sql() -> str:
    return r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least
  FROM documents),
masks AS (
  SELECT part,
         (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
         + 4 * (100 * len(regexp_extract_all(text, '[A-Z]')) > 3 * length(text))::INT
         + 8 * regexp_matches(text, '[#$%&*|]')::INT + 16 * coalesce(doc_id > least, FALSE)::INT AS mask,
         doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL) AS good,
         doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL) AS toxic
  FROM texts),
counts AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM masks GROUP BY part, mask),
letters(l, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT p.l || q.l || r.l || s.l || t.l AS filter_order, [p.b, q.b, r.b, s.b, t.b] AS bits
  FROM letters p, letters q, letters r, letters s, letters t
  WHERE len(list_distinct([p.b, q.b, r.b, s.b, t.b])) = 5),
steps AS (
  SELECT filter_order, step::INT AS step, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before, bits[step] AS now
  FROM orders, range(1, 6) r(step)),
found AS (
  SELECT part, filter_order, step, now,
         sum(CASE WHEN mask & (before | now) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN mask & before = 0 AND mask & now > 0 THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN mask & before > 0 AND mask & now > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN mask = now THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN mask & before = 0 AND mask & now > 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN mask & before = 0 AND mask & now > 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM counts, steps GROUP BY part, filter_order, step, now)
SELECT * EXCLUDE (now), (sum(removed) OVER (PARTITION BY part, now))::BIGINT AS shapley FROM found"""


def fill_in_middle_sql() -> str:
    return r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, ''))::BIGINT AS n,
         sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents),
drawn AS (
  SELECT *, ('0x' || substr(h, 1, 8))::BIGINT % (n + 1) AS x, ('0x' || substr(h, 9, 8))::BIGINT % (n + 1) AS y,
         n = 0 OR regexp_matches(text, '<[PSM]>') OR ('0x' || substr(h, 17, 8))::BIGINT % 100 >= 90 AS plain,
         ('0x' || substr(h, 25, 8))::BIGINT % 100 < 20 AS spm
  FROM texts),
cut AS (
  SELECT *, least(x, y) AS low, greatest(x, y) AS high, substr(text, 1, least(x, y)) AS prefix,
         substr(text, least(x, y) + 1, greatest(x, y) - least(x, y)) AS middle, substr(text, greatest(x, y) + 1) AS suffix
  FROM drawn)
SELECT doc_id, n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
       CASE WHEN NOT plain THEN low END AS prefix_chars, CASE WHEN NOT plain THEN high - low END AS middle_chars,
       sha256(CASE WHEN plain THEN text WHEN spm THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                   ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut"""


def llm_oracles() -> dict[str, str]:
    return {
        "op1_quality_rules": quality_rules_sql(),
        "op3_license_scan": license_scan_sql(),
        "op7_repeats": repeats_sql(repeats.SIZE),
        "op8_near_duplicates": near_duplicates_sql(),
        "op11_filter_audit": filter_audit_sql(),
        "op13_fill_in_middle": fill_in_middle_sql(),
    }
