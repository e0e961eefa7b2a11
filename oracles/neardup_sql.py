"""Near-duplicate queries in SQL, over the same whole tables and whole texts."""

import random

# Fixed values, written out here so that a wrong one in the library shows.
WHITE = r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
URL = rf"https?://[^{WHITE}]+"
URL_OR_WWW = rf"https?://[^{WHITE}]+|www\.[^{WHITE}]+"
ESTIMATE_SIZES = (32, 64, 128, 256)
SCORE_THRESHOLDS = (0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
EVAL_THRESHOLDS = (0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95)
COST_RATIOS = (10, 50, 100)
BIN_EDGES = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
CAPS = (50, 100, 150, 200, 300)
CONFIGURATIONS = {"32x4": (32, 4), "16x8": (16, 8), "8x16": (8, 16)}
PRIME = 4294967311
CORRIGENDUM = "(?i)corrigend(um|a)"


def bin_label(i: int) -> str:
    return f"({'-0.001' if i == 0 else i / 10}, {(i + 1) / 10}]"


def coefficients(k: int) -> list[tuple[int, int]]:
    """Multiplier and shift of each permutation, drawn in turn with seed 42."""
    drawn = random.Random(42)
    return [(drawn.randint(1, PRIME - 1), drawn.randint(0, PRIME - 1)) for _ in range(k)]


def _normal(url: str) -> str:
    return f"""trim(regexp_replace(regexp_replace(lower(coalesce("text", '')), '{url}', ' ', 'g'), '[^a-z0-9]+', ' ', 'g'))"""


NOTICES = """
days AS (SELECT doc_id, source, coalesce("text", '') AS body, CAST(doc_id AS VARCHAR) AS n,
  CASE WHEN doc_id % 9 = 0 AND doc_id >= 20 THEN doc_id - 20 ELSE doc_id END AS k, DATE '2024-01-01' + CAST(doc_id % 366 AS INTEGER) AS d FROM documents),
lines AS (
  SELECT doc_id, source, body, concat_ws(' ', CASE WHEN doc_id % 9 = 0 THEN 'Corrigendum' ELSE 'Notice' END, 'dated',
    CASE WHEN doc_id % 11 = 0 THEN '41-13-2024' ELSE CASE doc_id % 7 WHEN 0 THEN strftime(d, '%d-%m-%Y') WHEN 1 THEN strftime(d, '%d/%m/%Y') WHEN 2 THEN strftime(d, '%d.%m.%Y') WHEN 3 THEN strftime(d, '%Y-%m-%d') WHEN 4 THEN strftime(d, '%d %b %Y') WHEN 5 THEN strftime(d, '%b %d, %Y')
      ELSE strftime(d, '%d-%b-%y') END END, 'value',
    CASE doc_id % 5 WHEN 0 THEN 'Rs. 4,50,' || lpad(n, 3, '0') || '/-' WHEN 1 THEN 'Rs. ' || n || '.50 lakh' WHEN 2 THEN 'INR 4.' || lpad(n, 3, '0') || ' Cr'
      WHEN 3 THEN '4' || lpad(n, 7, '0') ELSE 'no amount' END, 'no.',
    CASE k % 8 WHEN 0 THEN 'NPAS-2024-' || lpad(CAST(k AS VARCHAR), 7, '0') WHEN 1 THEN 'SPC/2024-25/' || lpad(CAST(k AS VARCHAR), 6, '0')
      WHEN 2 THEN 'PWD/2024/' || lpad(CAST(k AS VARCHAR), 5, '0') WHEN 3 THEN '0' || lpad(CAST(k AS VARCHAR), 7, '0')
      WHEN 4 THEN 'ref-2024-' || lpad(CAST(k AS VARCHAR), 5, '0') WHEN 5 THEN 'MC/2025/W/' || lpad(CAST(k AS VARCHAR), 5, '0')
      WHEN 6 THEN 'TN-' || lpad(CAST(k AS VARCHAR), 6, '0') || '/2024' ELSE 'none' END, 'see',
    CASE doc_id % 3 WHEN 0 THEN 'http://portal.example/' || n WHEN 1 THEN 'www.portal.example/' || n ELSE 'no link' END) AS line
  FROM days),
notices AS MATERIALIZED (
  SELECT doc_id, source, body || chr(10) || CASE WHEN doc_id % 7 = 4 AND doc_id % 2 = 0 THEN upper(line) ELSE line END AS "text" FROM lines)"""

SEGMENTS = """
segs AS MATERIALIZED (
  SELECT doc_id, source AS portal, pos, trim(seg) AS seg FROM (
    SELECT doc_id, source, unnest(string_split("text", chr(10))) AS seg, generate_subscripts(string_split("text", chr(10)), 1) AS pos
    FROM documents) WHERE trim(seg) <> ''),
content_key AS MATERIALIZED (SELECT doc_id, portal, string_agg(seg, chr(10) ORDER BY pos) AS body FROM segs GROUP BY doc_id, portal),
common AS (
  SELECT s.portal, seg FROM segs s JOIN content_key k USING (doc_id)
  JOIN (SELECT d.source AS portal, count(DISTINCT coalesce(body, '')) AS n FROM documents d LEFT JOIN content_key USING (doc_id) GROUP BY 1) p
    ON p.portal = s.portal
  GROUP BY s.portal, seg, n HAVING count(DISTINCT body) >= greatest(3, n * 0.1)),
left_over AS (
  SELECT d.doc_id, d.source AS portal, string_agg(s.seg, chr(10) ORDER BY s.pos) AS whole,
    string_agg(s.seg, chr(10) ORDER BY s.pos) FILTER (c.seg IS NULL) AS rest, count(c.seg) AS cut
  FROM documents d LEFT JOIN segs s ON s.doc_id = d.doc_id LEFT JOIN common c ON c.portal = s.portal AND c.seg = s.seg
  GROUP BY d.doc_id, d.source)"""

TEXT = f"""
normal AS MATERIALIZED (SELECT doc_id, {_normal(URL)} AS normal FROM documents),
toks AS MATERIALIZED (SELECT doc_id, CASE WHEN normal = '' THEN [] ELSE string_split(normal, ' ') END AS t FROM normal)"""


def _word_grams(n: int) -> str:
    return f"""
word{n} AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(t[i:i + {n - 1}], ' ') AS g
  FROM (SELECT doc_id, t, unnest(range(1, len(t) - {n} + 2)) AS i FROM toks))"""


CHAR5 = """
char5 AS MATERIALIZED (
  SELECT DISTINCT doc_id, substr(normal, i, 5) AS g
  FROM (SELECT doc_id, normal, unnest(range(1, length(normal) - 3)) AS i FROM normal))"""

WORD5 = TEXT + "," + _word_grams(5)

PAIRS = """
long_lines AS (
  SELECT DISTINCT doc_id, trim(line) AS line FROM (SELECT doc_id, unnest(string_split("text", chr(10))) AS line FROM documents)
  WHERE length(trim(line)) >= 80),
same AS (
  SELECT DISTINCT id_a, doc_id AS id_b FROM long_lines JOIN (SELECT line, min(doc_id) AS id_a FROM long_lines GROUP BY line)
  USING (line) WHERE id_a < doc_id),
pairs AS MATERIALIZED (
  SELECT id_a, id_b, 'same' AS label FROM same
  UNION ALL SELECT a.doc_id, b.doc_id, 'different' FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1
    WHERE (a.doc_id, b.doc_id) NOT IN (SELECT (id_a, id_b) FROM same))"""


def _scores(pairs: str, grams: str, name: str) -> str:
    """Exact Jaccard of the pairs in ``pairs`` over the sets in ``grams``."""
    return f"""
{name}_size AS (SELECT d.doc_id, count(g) AS n FROM documents d LEFT JOIN {grams} USING (doc_id) GROUP BY d.doc_id),
{name}_common AS (
  SELECT p.id_a, p.id_b, count(*) AS n FROM (SELECT DISTINCT id_a, id_b FROM {pairs}) p
  JOIN {grams} a ON a.doc_id = p.id_a JOIN {grams} b ON b.doc_id = p.id_b AND b.g = a.g GROUP BY p.id_a, p.id_b),
{name} AS MATERIALIZED (
  SELECT p.id_a, p.id_b, CASE WHEN a.n + b.n = 0 THEN 1.0::DOUBLE
    ELSE CAST(coalesce(c.n, 0) AS DOUBLE) / CAST(a.n + b.n - coalesce(c.n, 0) AS DOUBLE) END AS jaccard
  FROM (SELECT DISTINCT id_a, id_b FROM {pairs}) p JOIN {name}_size a ON a.doc_id = p.id_a
  JOIN {name}_size b ON b.doc_id = p.id_b LEFT JOIN {name}_common c ON c.id_a = p.id_a AND c.id_b = p.id_b)"""


WORD = lambda i: f"CAST('0x' || substr(m, {8 * i + 1}, 8) AS BIGINT)"
HASHED = WORD5 + f""",
hashed AS MATERIALIZED (
  SELECT doc_id, g, (({WORD(3)} - 15 * {WORD(2)} + 225 * {WORD(1)} - 3375 * {WORD(0)}) % {PRIME} + {PRIME}) % {PRIME} AS h
  FROM (SELECT doc_id, g, md5(g) AS m FROM word5))"""


def _signatures(k: int) -> str:
    values = ", ".join(f"({i}, {a}, {b})" for i, (a, b) in enumerate(coefficients(k)))
    return HASHED + f""",
coefs AS (SELECT * FROM (VALUES {values}) v(i, a, b)),
sigs AS MATERIALIZED (
  SELECT doc_id, i, min(((((a // 65536) * h) % {PRIME}) * 65536 + (a % 65536) * h + b) % {PRIME}) AS v
  FROM (SELECT DISTINCT doc_id, h FROM hashed), (SELECT i, CAST(a AS BIGINT) AS a, CAST(b AS BIGINT) AS b FROM coefs)
  GROUP BY doc_id, i)"""


SIGS = _signatures(128)
BUCKETS = SIGS + """,
buckets AS MATERIALIZED (
  SELECT doc_id, i // 4 AS band, string_agg(CAST(v AS VARCHAR), '_' ORDER BY i) AS key FROM sigs GROUP BY doc_id, i // 4)"""
ALL_BUCKETS = SIGS + """,
all_buckets AS MATERIALIZED (
""" + "\n  UNION ALL ".join(
    f"""SELECT '{name}' AS configuration, doc_id, i // {rows} AS band, string_agg(CAST(v AS VARCHAR), '_' ORDER BY i) AS key
  FROM sigs GROUP BY doc_id, i // {rows}""" for name, (_, rows) in CONFIGURATIONS.items()
) + """),
sizes AS (SELECT configuration, band, key, count(*) AS bucket_size FROM all_buckets GROUP BY ALL)"""
CONFIG_NAMES = "(VALUES " + ", ".join(f"('{n}')" for n in CONFIGURATIONS) + ") c(configuration)"
COUNTS = """,
counts AS MATERIALIZED (
  SELECT d.doc_id, d.source AS portal, c.configuration, coalesce(n, 0) AS candidate_count
  FROM documents d CROSS JOIN """ + CONFIG_NAMES + """ LEFT JOIN (
    SELECT a.configuration, a.doc_id, count(DISTINCT b.doc_id) AS n FROM all_buckets a JOIN all_buckets b
    ON a.configuration = b.configuration AND a.band = b.band AND a.key = b.key AND a.doc_id <> b.doc_id
    GROUP BY a.configuration, a.doc_id) x ON x.doc_id = d.doc_id AND x.configuration = c.configuration)"""
SURVIVED = "," + PAIRS + """,
hits AS (
  SELECT DISTINCT p.id_a, p.id_b, a.configuration FROM pairs p JOIN all_buckets a ON a.doc_id = p.id_a
  JOIN all_buckets b ON b.doc_id = p.id_b AND a.configuration = b.configuration AND a.band = b.band AND a.key = b.key),
survived AS (
  SELECT c.configuration, p.id_a, p.id_b, p.label, (h.id_a IS NOT NULL)::INT AS hit
  FROM pairs p CROSS JOIN """ + CONFIG_NAMES + """ LEFT JOIN hits h
    ON h.id_a = p.id_a AND h.id_b = p.id_b AND h.configuration = c.configuration)"""
CANDIDATES = BUCKETS + """,
cands AS MATERIALIZED (
  SELECT DISTINCT a.doc_id AS id_a, b.doc_id AS id_b
  FROM buckets a JOIN buckets b ON a.band = b.band AND a.key = b.key AND a.doc_id < b.doc_id
  JOIN (SELECT band, key FROM buckets GROUP BY band, key HAVING count(*) <= 100) ok ON ok.band = a.band AND ok.key = a.key)"""
SCORED = CANDIDATES + "," + _scores("cands", "word5", "scored")
# Every bucket counts, whatever its size.
MATCHES = BUCKETS + """,
linked AS MATERIALIZED (
  SELECT DISTINCT a.doc_id AS id_a, b.doc_id AS id_b FROM buckets a JOIN buckets b ON a.band = b.band AND a.key = b.key AND a.doc_id < b.doc_id)
""" + "," + _scores("linked", "word5", "all_scored") + """,
matches AS MATERIALIZED (SELECT * FROM all_scored WHERE jaccard >= 0.5),
content AS MATERIALIZED (
  SELECT doc_id, min(doc_id) OVER (PARTITION BY grams) AS rep FROM (
    SELECT doc_id, string_agg(g, '|' ORDER BY g) AS grams FROM word5 GROUP BY doc_id)),
different AS (SELECT * FROM all_scored WHERE id_a IN (SELECT rep FROM content) AND id_b IN (SELECT rep FROM content)),
match_pairs AS MATERIALIZED (SELECT * FROM different WHERE jaccard >= 0.5)"""
# Documents with neighbours are visited in order; the list of centers so far decides each next one.
STARS = MATCHES + """,
edges AS (SELECT id_a AS v, id_b AS u FROM matches UNION SELECT id_b, id_a FROM matches),
visits AS MATERIALIZED (SELECT v, list(u) AS near, row_number() OVER (ORDER BY v) AS step FROM edges GROUP BY v),
walk(step, centers) AS (
  SELECT CAST(0 AS BIGINT), CAST([] AS BIGINT[])
  UNION ALL
  SELECT x.step, CASE WHEN list_has_any(w.centers, x.near) THEN w.centers ELSE list_append(w.centers, x.v) END
  FROM walk w JOIN visits x ON x.step = w.step + 1),
chosen AS MATERIALIZED (SELECT unnest(centers) AS center FROM (SELECT centers FROM walk ORDER BY step DESC LIMIT 1)),
stars AS (
  SELECT d.doc_id, coalesce(o.center, d.doc_id) AS center FROM documents d LEFT JOIN (
    SELECT e.v, min(e.u) AS center FROM edges e JOIN chosen c ON c.center = e.u
    WHERE e.v NOT IN (SELECT center FROM chosen) GROUP BY e.v) o ON o.v = d.doc_id),
mapping AS (
  SELECT doc_id, center, coalesce(
      CASE WHEN doc_id % 10 = 0 THEN 'old-' || CAST(doc_id AS VARCHAR) END,
      CASE WHEN center % 10 = 0 THEN 'old-' || CAST(center AS VARCHAR) END,
      h[1:8] || '-' || h[9:12] || '-' || h[13:16] || '-' || h[17:20] || '-' || h[21:32]) AS cluster_id,
    doc_id = center AND doc_id % 10 <> 0 AS created, doc_id = center AND doc_id % 10 = 0 AS reused
  FROM (SELECT *, sha256(CAST(center AS VARCHAR)) AS h FROM stars))"""
CONTENTS = """,
content AS MATERIALIZED (
  SELECT doc_id, min(doc_id) OVER (PARTITION BY grams) AS rep FROM (
    SELECT doc_id, string_agg(g, '|' ORDER BY g) AS grams FROM word5 GROUP BY doc_id))"""
FILTERED_SOURCE = """
filtered AS MATERIALIZED (SELECT doc_id, coalesce(rest, whole, '') AS "text" FROM left_over),"""


def _on_filtered(query: str, url: str = URL) -> str:
    """The same tables with the filtered texts in the place of the documents' own."""
    plain = f"SELECT doc_id, {_normal(URL)} AS normal FROM documents"
    return query.replace(plain, f"SELECT doc_id, {_normal(url)} AS normal FROM filtered")


SIMILARITY = (
    TEXT + "," + ",".join(_word_grams(n) for n in (3, 5)) + "," + CHAR5 + "," + PAIRS + ","
    + ",".join(_scores("pairs", g, f"s_{g}") for g in ("word3", "word5", "char5")) + """,
similarity AS (
  SELECT p.id_a, p.id_b, p.label, a.jaccard AS word3_jaccard, b.jaccard AS word5_jaccard, c.jaccard AS char5_jaccard
  FROM pairs p JOIN s_word3 a USING (id_a, id_b) JOIN s_word5 b USING (id_a, id_b) JOIN s_char5 c USING (id_a, id_b))"""
)
EXACT = WORD5 + "," + PAIRS + "," + _scores("pairs", "word5", "s_word5") + """,
exact AS (SELECT p.id_a, p.id_b, p.label, s.jaccard FROM pairs p JOIN s_word5 s USING (id_a, id_b))"""
EXACT_TAIL = "," + _scores("pairs", "word5", "s_word5") + """,
exact AS (SELECT p.id_a, p.id_b, p.label, s.jaccard FROM pairs p JOIN s_word5 s USING (id_a, id_b))"""
ERRORS = _signatures(256) + "," + PAIRS + EXACT_TAIL + """,
agree AS (
  SELECT p.id_a, p.id_b, k, sum((a.v = b.v AND a.i < k)::INT) AS hits FROM pairs p JOIN sigs a ON a.doc_id = p.id_a
  JOIN sigs b ON b.doc_id = p.id_b AND a.i = b.i,
  (VALUES """ + ", ".join(f"({k})" for k in ESTIMATE_SIZES) + """) s(k) GROUP BY p.id_a, p.id_b, k),
signed AS (SELECT DISTINCT doc_id FROM sigs),
errors AS MATERIALIZED (
  SELECT e.id_a, e.id_b, e.label, e.jaccard, s.k AS signature_size, estimate, abs(estimate - e.jaccard) AS error
  FROM exact e, (VALUES """ + ", ".join(f"({k})" for k in ESTIMATE_SIZES) + """) s(k), LATERAL (
    SELECT CASE WHEN e.id_a NOT IN (SELECT doc_id FROM signed) AND e.id_b NOT IN (SELECT doc_id FROM signed) THEN 1.0::DOUBLE
      ELSE coalesce((SELECT CAST(hits AS DOUBLE) / k FROM agree g WHERE g.id_a = e.id_a AND g.id_b = e.id_b AND g.k = s.k), 0.0::DOUBLE)
      END AS estimate))"""
EVAL = EXACT + """,
evaluated AS (
  SELECT threshold, tp, fp, tn, fn, precision_, recall_,
    CASE WHEN precision_ + recall_ = 0 THEN 0.0::DOUBLE ELSE precision_ * recall_ * 2 / (precision_ + recall_) END AS f1
  FROM (SELECT *, CASE WHEN tp + fp = 0 THEN 0.0::DOUBLE ELSE CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) END AS precision_,
    CASE WHEN tp + fn = 0 THEN 0.0::DOUBLE ELSE CAST(tp AS DOUBLE) / CAST(tp + fn AS DOUBLE) END AS recall_
  FROM (SELECT threshold, count(*) FILTER (label = 'same' AND jaccard >= threshold) AS tp,
    count(*) FILTER (label = 'different' AND jaccard >= threshold) AS fp,
    count(*) FILTER (label = 'different' AND jaccard < threshold) AS tn,
    count(*) FILTER (label = 'same' AND jaccard < threshold) AS fn
  FROM exact, (VALUES """ + ", ".join(f"({t}::DOUBLE)" for t in EVAL_THRESHOLDS) + """) g(threshold) GROUP BY threshold)))"""
DISTRIBUTION = """SELECT configuration, round(avg(candidate_count), 2) AS mean_candidates,
  round(quantile_cont(candidate_count::DOUBLE, 0.5), 2) AS p50_candidates, round(quantile_cont(candidate_count::DOUBLE, 0.9), 2) AS p90_candidates,
  round(quantile_cont(candidate_count::DOUBLE, 0.95), 2) AS p95_candidates, round(quantile_cont(candidate_count::DOUBLE, 0.99), 2) AS p99_candidates,
  max(candidate_count) AS max_candidates FROM counts GROUP BY configuration"""
RECALL = """SELECT configuration, round(avg(hit) FILTER (label = 'same') * 100, 2) AS same_pair_recall,
  round(avg(hit) FILTER (label = 'different') * 100, 2) AS different_pair_survival FROM survived GROUP BY configuration"""
BIN = "CASE " + " ".join(f"WHEN jaccard <= {e}::DOUBLE THEN {i}" for i, e in enumerate(BIN_EDGES[1:])) + " END"
BIN_NAMES = "(VALUES " + ", ".join(f"({i}, '{bin_label(i)}', {(( -0.001 if i == 0 else BIN_EDGES[i]) + BIN_EDGES[i + 1]) / 2:.6f}::DOUBLE)" for i in range(10)) + ") b(bin, similarity_bin, midpoint)"
BY_BIN = ALL_BUCKETS + SURVIVED + EXACT_TAIL + f""",
by_bin AS (
  SELECT c.configuration, b.bin, b.similarity_bin, b.midpoint, count(x.hit) AS pairs, coalesce(sum(x.hit), 0)::BIGINT AS survived,
    round(avg(x.hit) * 100, 2) AS survival_rate
  FROM {CONFIG_NAMES} CROSS JOIN {BIN_NAMES} LEFT JOIN (
    SELECT configuration, {BIN} AS bin, hit FROM survived JOIN exact USING (id_a, id_b)) x
  ON x.configuration = c.configuration AND x.bin = b.bin GROUP BY 1, 2, 3, 4)"""
DATE_TEXT = {
    "%d-%m-%Y": r"\b(\d{1,2}-\d{1,2}-\d{4})\b", "%d/%m/%Y": r"\b(\d{1,2}/\d{1,2}/\d{4})\b",
    "%d.%m.%Y": r"\b(\d{1,2}\.\d{1,2}\.\d{4})\b", "%Y-%m-%d": r"\b(\d{4}-\d{1,2}-\d{1,2})\b",
    "%d %b %Y": r"\b(\d{1,2} [A-Z][A-Za-z]{2} \d{4})\b", "%b %d, %Y": r"\b([A-Z][A-Za-z]{2} \d{1,2}, \d{4})\b",
    "%d-%b-%y": r"\b(\d{1,2}-[A-Z][A-Za-z]{2}-\d{2})\b",
}
MONEY_TEXT = r"(?i)(?:rs\.?|inr|rupees)\s*([0-9][0-9,]*(?:\.[0-9]+)?)\s*(lakh|cr)?|\b([1-9][0-9]{6,11})\b"
REFERENCE_TEXT = r"\b(NPAS-\d{4}-\d{7}|SPC/\d{4}-\d{2}/\d{6}|PWD/\d{4}/\d{5}|ref-\d{4}-\d{5}|MC/\d{4}/W/\d{5}|TN-\d{6}/\d{4}|0\d{7})\b"
ANY_DATE = "|".join(f"(?:{p})" for p in DATE_TEXT.values())
FIRST_DATE = f"try_strptime(regexp_extract(\"text\", '{ANY_DATE}', 0), [" + ", ".join(f"'{f}'" for f in DATE_TEXT) + "])"


SPIKES = """
shown AS MATERIALIZED (
  SELECT source, CASE WHEN source IN ('src6', 'src7') THEN "text"[1 : CAST(source[4:] AS INTEGER) * 100 + 30] ELSE "text" END AS body FROM documents),
histogram AS MATERIALIZED (
  SELECT source AS portal, CAST(length(coalesce(body, '')) AS BIGINT) AS length, count(*) AS docs FROM shown GROUP BY 1, 2),
spikes AS (
  SELECT h.portal, h.length, h.docs, CAST(coalesce(sum(o.docs), 0) AS BIGINT) AS around FROM histogram h
  LEFT JOIN histogram o ON o.portal = h.portal AND o.length <> h.length AND abs(o.length - h.length) <= 50
  WHERE h.docs >= 3 AND h.length > 0 GROUP BY 1, 2, 3 HAVING h.docs * 100 >= coalesce(sum(o.docs), 0) * 20 AND h.docs >= 2 * coalesce(max(o.docs), 0))"""


def _clauses(word: str, count: int) -> str:
    return f"(SELECT string_agg('{word} ' || i || ' of the terms applies to this notice,', ' ' ORDER BY i) FROM range(1, {count + 1}) r(i))"


def _ends(name: str, words: str) -> str:
    """Longest common beginnings of the word lists ``words``.

    k words are common if enough contents agree in them, so the longest such k of a text is its m-th longest agreement with a content, m
    being enough. The comparison with every content that has the same first 16 words takes the place of counting prefixes.
    """
    return f"""
{name}_words AS MATERIALIZED (SELECT doc_id, portal, {words} AS w FROM cut WHERE len(t) >= 16),
{name}_agree AS (
  SELECT a.doc_id, a.portal, len(a.w) AS n, coalesce(list_position(
    list_transform(range(1, least(len(a.w), len(b.w)) + 1), lambda i: a.w[i] <> b.w[i]), true) - 1, least(len(a.w), len(b.w))) AS agreed
  FROM {name}_words a JOIN (SELECT DISTINCT portal, w FROM {name}_words) b ON a.portal = b.portal AND a.w[1:16] = b.w[1:16]),
{name} AS (
  SELECT doc_id, least(agreed, n - 1) AS words FROM (
    SELECT x.doc_id, x.n, x.agreed, row_number() OVER (PARTITION BY x.doc_id ORDER BY x.agreed DESC) AS place,
      ceil(greatest(3, s.n * 0.1)) AS enough FROM {name}_agree x JOIN sizes s ON s.portal = x.portal)
  WHERE place = enough AND least(agreed, n - 1) >= 16)"""


AGGREGATED = f"""
numbered AS (
  SELECT doc_id, source AS portal, replace(coalesce("text", ''), chr(10), ' ') AS run, TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER) AS k
  FROM documents),
bodies AS (
  SELECT doc_id, portal, CASE WHEN k <= 5 THEN {_clauses("Clause", 30)} || ' ' || CASE WHEN k <= 2 THEN 'National ' ELSE 'State ' END ELSE '' END
    || run || CASE WHEN k IN (1, 2, 5) THEN ' ' || {_clauses("Remark", 12)} ELSE '' END AS body FROM numbered),
cut AS MATERIALIZED (SELECT doc_id, portal, body, list_filter(string_split_regex(body, '\\s+'), lambda w: w <> '') AS t FROM bodies),
sizes AS (SELECT portal, count(DISTINCT t) AS n FROM cut GROUP BY portal),
{_ends("heads", "t")},
{_ends("tails", "list_reverse(t)")}"""


def _with(tables: str, select: str, recursive: bool = False) -> str:
    return f"WITH {'RECURSIVE ' if recursive else ''}{tables}\n{select}"


def _extremes(kind: str, label: str, order: str) -> str:
    return f"""(SELECT '{kind}' AS kind, id_a, id_b, word5_jaccard FROM similarity WHERE label = '{label}'
  ORDER BY word5_jaccard {order}, id_a, id_b LIMIT 10)"""


LONG_SIMILARITY = " UNION ALL ".join(
    f"SELECT '{m}' AS measure, label, {m} AS value FROM similarity" for m in ("word3_jaccard", "word5_jaccard", "char5_jaccard"))

SQL = {
    "normalize_text": _with(NOTICES, f"SELECT doc_id, {_normal(URL)} AS normalized FROM notices"),
    "normalize_text_www": _with(NOTICES, f"SELECT doc_id, {_normal(URL_OR_WWW)} AS normalized FROM notices"),
    "word_tokens": _with(TEXT, "SELECT doc_id, CAST(i - 1 AS BIGINT) AS pos, t[i] AS token FROM (SELECT doc_id, t, unnest(range(1, len(t) + 1)) AS i FROM toks)"),
    "word_ngrams": _with(WORD5, "SELECT doc_id, g AS shingle FROM word5"),
    "char_ngrams": _with(TEXT + "," + CHAR5, "SELECT doc_id, count(*) AS shingles, min(g) AS first, max(g) AS last FROM char5 GROUP BY doc_id"),
    "shingle_hash": _with(HASHED, "SELECT doc_id, g AS shingle, h AS hash FROM hashed"),
    "label_counts": _with(PAIRS, "SELECT label, count(*) AS pairs FROM pairs GROUP BY label"),
    "pair_endpoints": _with(PAIRS, "SELECT id_a AS doc_id FROM pairs UNION SELECT id_b FROM pairs"),
    "pair_jaccard": _with(EXACT, "SELECT * FROM exact"),
    "pair_similarity": _with(SIMILARITY, "SELECT * FROM similarity"),
    "similarity_summary": _with(SIMILARITY, f"""SELECT measure, label, count(value) AS count, round(avg(value), 6) AS mean,
  round(quantile_cont(value, 0.5), 6) AS median, round(min(value), 6) AS min, round(max(value), 6) AS max
  FROM ({LONG_SIMILARITY}) GROUP BY measure, label"""),
    "pair_extremes": _with(SIMILARITY, " UNION ALL ".join([
        _extremes("different_highest", "different", "DESC"), _extremes("same_lowest", "same", "ASC"),
        _extremes("same_highest", "same", "DESC")])),
    "minhash_signature": _with(SIGS, "SELECT doc_id, md5(string_agg(CAST(v AS VARCHAR), ',' ORDER BY i)) AS signature_md5 FROM sigs GROUP BY doc_id"),
    "signature_long": _with(SIGS, "SELECT doc_id, CAST(i AS BIGINT) AS hash_position, v AS hash_value FROM sigs"),
    "signature_upsert": _with(SIGS, "SELECT doc_id, CAST(i AS BIGINT) AS hash_position, v AS hash_value FROM sigs"),
    "minhash_estimate": _with(ERRORS, "SELECT id_a, id_b, CAST(signature_size AS BIGINT) AS signature_size, estimate FROM errors"),
    "minhash_error": _with(ERRORS, """SELECT CAST(signature_size AS BIGINT) AS signature_size, round(avg(error), 6) AS mae,
  round(sqrt(avg(error * error)), 6) AS rmse, round(quantile_cont(error, 0.95), 6) AS p95_absolute_error,
  round(max(error), 6) AS max_absolute_error FROM errors GROUP BY 1"""),
    "minhash_error_by_label": _with(ERRORS, """SELECT CAST(signature_size AS BIGINT) AS signature_size, label, count(error) AS count,
  round(avg(error), 6) AS mean, round(quantile_cont(error, 0.5), 6) AS median, round(max(error), 6) AS max
  FROM errors GROUP BY 1, 2"""),
    "minhash_worst": _with(ERRORS, """SELECT CAST(signature_size AS BIGINT) AS signature_size, place, id_a, id_b, label, jaccard, estimate, error
  FROM (SELECT *, row_number() OVER (PARTITION BY signature_size ORDER BY error DESC, id_a, id_b) AS place FROM errors)
  WHERE place <= 5"""),
    "lsh_buckets": _with(BUCKETS, """SELECT CAST(band AS BIGINT) AS band, min(doc_id) AS first_doc, count(*) AS bucket_size
  FROM buckets GROUP BY band, key HAVING count(*) > 1"""),
    "bucket_stats": _with(ALL_BUCKETS, """SELECT configuration, count(*) AS buckets, round(avg(bucket_size), 2) AS mean_size,
  quantile_cont(bucket_size::DOUBLE, 0.5) AS median_size, max(bucket_size) AS max_size FROM sizes GROUP BY configuration"""),
    "candidate_counts": _with(ALL_BUCKETS + COUNTS, "SELECT * FROM counts"),
    "candidate_distribution": _with(ALL_BUCKETS + COUNTS, DISTRIBUTION),
    "lsh_recall": _with(ALL_BUCKETS + SURVIVED, RECALL),
    "lsh_label_summary": _with(ALL_BUCKETS + SURVIVED, """SELECT configuration, label, count(*) AS count, CAST(sum(hit) AS BIGINT) AS sum,
  round(avg(hit), 4) AS mean FROM survived GROUP BY configuration, label"""),
    "survival_by_bin": _with(BY_BIN, "SELECT configuration, CAST(bin AS BIGINT) AS bin, similarity_bin, pairs, survived, survival_rate FROM by_bin"),
    "survival_curve": _with(BY_BIN, """SELECT configuration, similarity_bin, midpoint AS similarity_midpoint,
  round(survival_rate / 100, 6) AS survival_prob FROM by_bin"""),
    "lsh_config_summary": _with(ALL_BUCKETS + COUNTS + SURVIVED, f"""SELECT d.configuration,
  CAST(string_split(d.configuration, 'x')[1] AS BIGINT) AS bands, CAST(string_split(d.configuration, 'x')[2] AS BIGINT) AS rows,
  buckets, mean_candidates, p50_candidates, p90_candidates, p95_candidates, p99_candidates, max_candidates,
  same_pair_recall, different_pair_survival
  FROM ({DISTRIBUTION}) d JOIN ({RECALL}) r USING (configuration)
  JOIN (SELECT configuration, count(*) AS buckets FROM sizes GROUP BY configuration) s USING (configuration)"""),
    "bucket_cap_sweep": _with(BUCKETS + "," + PAIRS, f"""SELECT CAST(cap AS BIGINT) AS cap, label,
  count(*) FILTER (smallest <= cap) AS retrieved, count(*) AS total,
  round(CAST(count(*) FILTER (smallest <= cap) AS DOUBLE) / count(*), 4) AS share
  FROM (SELECT p.id_a, p.id_b, p.label, min(z.n) AS smallest FROM pairs p
        LEFT JOIN (SELECT a.doc_id AS x, b.doc_id AS y, a.band, a.key FROM buckets a JOIN buckets b ON a.band = b.band AND a.key = b.key) k
          ON k.x = p.id_a AND k.y = p.id_b
        LEFT JOIN (SELECT band, key, count(*) AS n FROM buckets GROUP BY band, key) z ON z.band = k.band AND z.key = k.key
        GROUP BY p.id_a, p.id_b, p.label),
  (VALUES {", ".join(f"({c})" for c in CAPS)}) v(cap) GROUP BY cap, label"""),
    "lsh_candidates": _with(CANDIDATES, "SELECT * FROM cands"),
    "scored_candidates": _with(SCORED, "SELECT * FROM scored"),
    "threshold_counts": _with(MATCHES, f"""SELECT threshold, (SELECT count(*) FROM different WHERE jaccard >= threshold) AS pairs
  FROM (VALUES {", ".join(f"({t}::DOUBLE)" for t in SCORE_THRESHOLDS)}) v(threshold)"""),
    "threshold_eval": _with(EVAL, """SELECT threshold, tp, fp, tn, fn, precision_ AS "precision", recall_ AS "recall", f1 FROM evaluated"""),
    "threshold_cost": _with(EVAL, f"""SELECT ratio, minimum_cost, threshold FROM (
  SELECT CAST(ratio AS BIGINT) AS ratio, fp * ratio + fn AS minimum_cost, threshold,
    row_number() OVER (PARTITION BY ratio ORDER BY fp * ratio + fn, threshold) AS place
  FROM evaluated, (VALUES {", ".join(f"({r})" for r in COST_RATIOS)}) v(ratio)) WHERE place = 1"""),
    "match_pairs": _with(MATCHES, "SELECT * FROM match_pairs"),
    "insert_if_absent": _with(MATCHES, "SELECT id_a, id_b, CASE WHEN id_a % 2 = 0 THEN 0.0::DOUBLE ELSE jaccard END AS jaccard FROM match_pairs"),
    "star_clusters": _with(STARS, "SELECT doc_id, center FROM stars", True),
    "content_copies": _with(WORD5 + CONTENTS, "SELECT doc_id, rep FROM content WHERE doc_id <> rep"),
    "uncapped_matches": _with(MATCHES, "SELECT * FROM match_pairs"),
    "uncapped_clusters": _with(STARS, "SELECT doc_id, center FROM stars", True),
    "match_pairs_filtered": _with(SEGMENTS + "," + FILTERED_SOURCE + _on_filtered(MATCHES), "SELECT * FROM match_pairs"),
    "threshold_eval_filtered": _with(SEGMENTS + "," + FILTERED_SOURCE + _on_filtered(EVAL, URL_OR_WWW),
                                     """SELECT threshold, tp, fp, tn, fn, precision_ AS "precision", recall_ AS "recall", f1 FROM evaluated"""),
    "stable_mapping": _with(STARS, "SELECT * FROM mapping", True),
    "cluster_table": _with(STARS, "SELECT cluster_id, center AS canonical_doc_id FROM mapping WHERE created", True),
    "cluster_summary": _with(STARS, """SELECT count(*) AS clusters, CAST(sum(docs) AS BIGINT) AS mapped, CAST(sum(created) AS BIGINT) AS created,
  CAST(sum(reused) AS BIGINT) AS reused, max(docs) AS largest
  FROM (SELECT cluster_id, count(*) AS docs, sum(created::INT) AS created, sum(reused::INT) AS reused FROM mapping GROUP BY cluster_id)""", True),
    "portal_volume": """SELECT source AS portal, count(*) AS docs FROM documents GROUP BY 1 ORDER BY docs DESC, portal LIMIT 15""",
    "boilerplate_filter": _with(SEGMENTS, """SELECT doc_id, portal, md5(coalesce(rest, whole, '')) AS filtered_md5,
  CASE WHEN rest IS NULL THEN 0 ELSE cut END AS removed FROM left_over"""),
    "corrigendum_flag": _with(NOTICES, f"""SELECT doc_id, regexp_matches(string_split("text", chr(10))[1], '{CORRIGENDUM}') AS in_title,
  regexp_matches("text", '{CORRIGENDUM}') AS in_body FROM notices"""),
    "corrigendum_links": _with(MATCHES + "," + NOTICES + f""",
flags AS (
  SELECT doc_id, source, regexp_matches("text", '{CORRIGENDUM}') AS flag, nullif(regexp_extract("text", '{REFERENCE_TEXT}', 1), '') AS ref
  FROM notices),
ways AS (
  SELECT c.doc_id AS correction, o.doc_id AS original, 1 AS named, 0 AS alike FROM flags c JOIN flags o
    ON c.ref = o.ref AND c.source = o.source AND o.doc_id < c.doc_id WHERE c.flag AND NOT o.flag
  UNION ALL
  SELECT c.doc_id, o.doc_id, 0, 1 FROM match_pairs m JOIN flags c ON c.doc_id = m.id_b JOIN flags o ON o.doc_id = m.id_a
    WHERE c.flag AND NOT o.flag)""", """SELECT correction, original, max(named) = 1 AS by_reference, max(alike) = 1 AS by_match FROM ways
  GROUP BY correction, original QUALIFY row_number() OVER (PARTITION BY correction ORDER BY original DESC) = 1"""),
    "portal_field_parse": _with(NOTICES, f"""SELECT source AS portal, count(*) AS docs, count(*) FILTER (regexp_matches("text", '{ANY_DATE}')) AS date_texts,
  count({FIRST_DATE}) AS dates, count(*) FILTER (regexp_matches("text", '{MONEY_TEXT}')) AS money_texts,
  count(*) FILTER (coalesce(nullif(regexp_extract("text", '{MONEY_TEXT}', 1), ''), nullif(regexp_extract("text", '{MONEY_TEXT}', 3), '')) IS NOT NULL) AS amounts,
  count(nullif(regexp_extract("text", '{REFERENCE_TEXT}', 1), '')) AS refs FROM notices GROUP BY 1"""),
    "portal_profile": _with(SPIKES, """SELECT p.portal, p.docs, upper_share, c.length AS cut_length, c.docs AS cut_docs,
  m.length AS mode_length, m.docs AS mode_docs
  FROM (SELECT source AS portal, count(*) AS docs, round(avg((body = upper(body))::INT), 6) AS upper_share FROM shown GROUP BY 1) p
  JOIN (SELECT * FROM histogram QUALIFY row_number() OVER (PARTITION BY portal ORDER BY docs DESC, length) = 1) m ON m.portal = p.portal
  LEFT JOIN (SELECT * FROM spikes QUALIFY row_number() OVER (PARTITION BY portal ORDER BY docs DESC, length) = 1) c ON c.portal = p.portal"""),
    "length_spikes": _with(SPIKES, "SELECT portal, length, docs, around FROM spikes"),
    "preamble_filter": _with(AGGREGATED, """SELECT doc_id, portal, head AS head_words, tail AS tail_words,
  md5(CASE WHEN head + tail > 0 THEN array_to_string(t[head + 1 : len(t) - tail], ' ') ELSE body END) AS filtered_md5
  FROM (SELECT c.doc_id, c.portal, c.t, c.body, coalesce(h.words, 0) AS head,
          CASE WHEN coalesce(h.words, 0) + coalesce(f.words, 0) >= len(c.t) THEN 0 ELSE coalesce(f.words, 0) END AS tail
        FROM cut c LEFT JOIN heads h ON h.doc_id = c.doc_id LEFT JOIN tails f ON f.doc_id = c.doc_id)"""),
    "notices_roundtrip": _with(NOTICES, """SELECT CAST(doc_id AS VARCHAR) AS notice_id, source AS portal_id,
  'Notice "' || doc_id || '", second' || chr(10) || 'line' AS title, md5("text") AS body_md5, doc_id * 1.5::DOUBLE AS estimated_value,
  '2024-03-01 10:00:00' AS published_at FROM notices"""),
}
