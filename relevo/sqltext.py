"""DuckDB SQL fragments mirroring the Spark text expressions (oracle side).

Used only to write the reference SQL each registered query is checked
against; the engine itself never parses SQL.
"""

from __future__ import annotations

# Same character class as functions.text.WHITESPACE_CLASS, in RE2 syntax.
WS = (r"[\t\n\x0B\f\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
      r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+")
ALPHA = r"[\p{L}\p{Nl}\p{No}_]+"


def words(e: str) -> str:
    return f"list_filter(regexp_split_to_array({e}, '{WS}'), lambda x: x <> '')"


def first_words(e: str, n: int) -> str:
    return f"array_to_string(list_slice({words(e)}, 1, {n}), ' ')"


def word_count(e: str) -> str:
    return f"CAST(len({words(e)}) AS BIGINT)"


def overlap(words_of: str, found_in: str) -> str:
    return f"CAST(len(list_filter({words(words_of)}, lambda w: instr({found_in}, w) > 0)) AS BIGINT)"


def alpha_tokens(e: str) -> str:
    return f"regexp_extract_all({e}, '{ALPHA}')"


def clip_both(e: str) -> str:
    return (f"CASE WHEN isnan({e}) THEN {e} WHEN {e} > 3 THEN 3.0 "
            f"WHEN {e} < 1 THEN 1.0 ELSE {e} END")


def clip_upper(e: str) -> str:
    return f"CASE WHEN isnan({e}) THEN {e} WHEN {e} > 3 THEN 3.0 ELSE {e} END"


PAIRS_CTE = f"""
terms AS (
  SELECT item_id, text AS search_term FROM benchmark),
pairs AS (
  SELECT d.doc_id AS id, d.doc_id - d.doc_id % 3 AS product_uid,
         coalesce(string_split(pt.text, chr(10))[1], '') AS product_title,
         t.search_term,
         CAST(1.0 AS DOUBLE) + CAST(l.quality AS DOUBLE)
           + (CAST(1.0 AS DOUBLE) - CAST(l.toxic AS DOUBLE)) AS relevance
  FROM documents d
  LEFT JOIN terms t ON t.item_id = d.doc_id % (SELECT count(*) FROM benchmark)
  LEFT JOIN documents pt ON pt.doc_id = d.doc_id - d.doc_id % 3
  LEFT JOIN labels l ON l.doc_id = d.doc_id),
descs AS (SELECT doc_id AS product_uid, text AS product_description FROM documents),
attrs AS (
  SELECT p_partkey AS product_uid, 0 AS pos, 'brand' AS name, CAST(p_brand AS VARCHAR) AS value FROM part
  UNION ALL SELECT p_partkey, 1, 'type', CAST(p_type AS VARCHAR) FROM part
  UNION ALL SELECT p_partkey, 2, 'size', CAST(p_size AS VARCHAR) FROM part),
attr_text AS (
  SELECT product_uid,
         string_agg(concat_ws(' ', name, coalesce(value, 'nan')), ' ' ORDER BY pos) AS product_attributes
  FROM attrs GROUP BY product_uid)
"""

# TF-IDF oracle: documents are pair rows, text = title . description .
TFIDF_CTE = f"""
docs AS (
  SELECT p.id, p.product_title || ' . ' || d.product_description || ' . ' AS all_texts
  FROM pairs p LEFT JOIN descs d USING (product_uid)),
dtok AS (SELECT DISTINCT id, unnest({alpha_tokens('all_texts')}) AS token FROM docs),
vocab AS (
  SELECT token, count(*) AS df,
         log2(CAST((SELECT count(*) FROM docs) AS DOUBLE) / count(*)) AS idf
  FROM dtok GROUP BY token),
texts AS (
  SELECT p.id, p.search_term AS q, p.product_title AS title, d.product_description AS "desc"
  FROM pairs p LEFT JOIN descs d USING (product_uid)),
bow AS (
  SELECT id AS key, field, token, count(*) AS tf FROM (
    SELECT id, 'q' AS field, unnest({alpha_tokens('q')}) AS token FROM texts
    UNION ALL SELECT id, 'title', unnest({alpha_tokens('title')}) FROM texts
    UNION ALL SELECT id, 'desc', unnest({alpha_tokens('"desc"')}) FROM texts)
  GROUP BY ALL),
w AS (
  SELECT b.key, b.field, b.token, b.tf * v.idf AS w
  FROM bow b JOIN vocab v USING (token) WHERE b.tf * v.idf <> 0),
nw AS (
  SELECT key, field, token, w, w / sqrt(sum(w * w) OVER (PARTITION BY key, field)) AS nw FROM w),
cos AS (
  SELECT q.key AS id, f.field, sum(q.nw * f.nw) AS c
  FROM nw q JOIN nw f ON q.key = f.key AND q.token = f.token AND q.field = 'q' AND f.field <> 'q'
  GROUP BY ALL)
"""

# Attribute flow base: pairs ⟕ (description + ' ' + bullets, brand, material), blanks for missing.
def attr_base_cte(brand: str) -> str:
    return f"""
base AS (
  SELECT p.id, p.product_uid, p.product_title, p.search_term, p.relevance,
         coalesce(d.product_description || ' ' || a.product_attributes, ' ') AS product_description,
         coalesce({brand}, ' ') AS brand, coalesce(doc.lang, ' ') AS material
  FROM pairs p LEFT JOIN descs d USING (product_uid)
  LEFT JOIN attr_text a USING (product_uid)
  LEFT JOIN documents doc ON doc.doc_id = p.product_uid)
"""


ATTR_BASE_CTE = attr_base_cte("nullif(doc.source, 'src0')")


def lcs_ratio_cte(name: str, src: str, a: str, b: str) -> str:
    """Recursive CTE ``name(id, ratio)``: 2*LCS(a, b)/(len a + len b), 1.0 when both empty."""
    return f"""
{name}_src AS (SELECT id, {a} AS a, {b} AS b FROM {src}),
{name}_dp(id, i, a, b, r) AS (
  SELECT id, 0, a, b, list_transform(range(0, length(b) + 1), lambda j: 0) FROM {name}_src
  UNION ALL
  SELECT id, i + 1, a, b,
    list_transform(range(0, length(b) + 1), lambda j:
      list_max(list_transform(range(0, j + 1), lambda k:
        CASE WHEN k = 0 THEN 0 ELSE greatest(r[k + 1], r[k] +
          CASE WHEN substr(a, i + 1, 1) = substr(b, k, 1) THEN 1 ELSE 0 END) END)))
  FROM {name}_dp WHERE i < length(a)),
{name} AS (
  SELECT id, CASE WHEN length(a) + length(b) = 0 THEN 1.0
                  ELSE 2.0 * r[length(b) + 1] / (length(a) + length(b)) END AS ratio
  FROM {name}_dp WHERE i = length(a))
"""

def lcs_diagonal_cte(name: str, src: str, a: str, b: str) -> str:
    """``lcs_ratio_cte`` for long texts: a step an anti-diagonal of the table, whose
    cells only need the two before (``p``, ``q``), not each other."""
    zeros = "list_transform(range(0, length(a)), lambda i: CAST(0 AS INTEGER))"
    return f"""
{name}_src AS (SELECT id, CASE WHEN length({a}) <= length({b}) THEN {a} ELSE {b} END AS a,
                      CASE WHEN length({a}) <= length({b}) THEN {b} ELSE {a} END AS b FROM {src}),
{name}_chars AS (SELECT id, string_split(a, '') AS ca, string_split(b, '') AS cb, length(a) AS n, length(b) AS m
                 FROM {name}_src),
{name}_dp(id, d, p, q) USING KEY (id) AS (
  SELECT id, 0, {zeros}, {zeros} FROM {name}_src
  UNION
  SELECT r.id, r.d + 1,
    list_transform(range(1, s.n + 1), lambda i:
      CASE WHEN r.d + 1 - i < 1 OR r.d + 1 - i > s.m THEN 0
           WHEN s.ca[i] = s.cb[r.d + 1 - i] THEN CASE WHEN i = 1 THEN 1 ELSE r.q[i - 1] + 1 END
           WHEN i = 1 THEN r.p[1] ELSE greatest(r.p[i - 1], r.p[i]) END), r.p
  FROM {name}_dp r JOIN {name}_chars s USING (id) WHERE r.d < s.n + s.m),
{name} AS (
  SELECT id, CASE WHEN n + m = 0 THEN 1.0 WHEN n = 0 THEN 0.0 ELSE 2.0 * p[n] / (n + m) END AS ratio
  FROM {name}_dp JOIN {name}_chars USING (id))
"""


LR3_CTE = f"""
lr3 AS (
  SELECT p.id, p.relevance,
         {word_count('p.search_term')} AS query_len,
         {overlap('p.search_term', 'p.product_title')} AS common_title,
         {overlap('p.search_term', 'd.product_description')} AS common_descriptoin
  FROM pairs p LEFT JOIN descs d USING (product_uid)),
train AS (SELECT * FROM lr3 WHERE relevance IS NOT NULL),
folds AS (SELECT *, CAST(ntile(10) OVER (ORDER BY id) - 1 AS INTEGER) AS fold FROM train)
"""


def cv_ols_cte(features: list[str]) -> str:
    """Per (feature, fold): closed-form OLS on the other folds, RMSE on the fold."""
    long = " UNION ALL ".join(
        f"SELECT id, fold, relevance, '{f}' AS feature, CAST({f} AS DOUBLE) AS x FROM folds"
        for f in features)
    return f"""
long AS ({long}),
fs AS (
  SELECT f.feature, f.fold, regr_intercept(t.relevance, t.x) AS a, regr_slope(t.relevance, t.x) AS b
  FROM (SELECT DISTINCT feature, fold FROM long) f
  JOIN long t ON t.feature = f.feature AND t.fold <> f.fold GROUP BY ALL),
fr AS (
  SELECT t.feature, t.fold, sqrt(avg(power(t.relevance - (fs.a + fs.b * t.x), 2))) AS rmse
  FROM long t JOIN fs USING (feature, fold) GROUP BY ALL),
cvm AS (SELECT feature, avg(rmse) AS mean_rmse FROM fr GROUP BY feature)
"""

def linear3_cte(alpha: float = 0.0) -> str:
    """``fit(b0, b1, b2, b3)`` on the three overlap features of ``train``: the
    centred normal equations (with ``alpha`` on their diagonal) by cofactors."""
    xs = ("query_len", "common_title", "common_descriptoin")
    sums = ", ".join(f"count(*) * covar_pop({xs[i]}, {xs[j]}) + {alpha if i == j else 0} AS a{i + 1}{j + 1}"
                     for i in range(3) for j in range(i, 3))
    rhs = ", ".join(f"count(*) * covar_pop({x}, relevance) AS t{i + 1}, avg({x}) AS m{i + 1}" for i, x in enumerate(xs))
    return f"""
moments AS (SELECT {sums}, {rhs}, avg(relevance) AS my FROM train),
cofactors AS (
  SELECT *, a22 * a33 - a23 * a23 AS c11, a13 * a23 - a12 * a33 AS c12, a12 * a23 - a13 * a22 AS c13,
         a11 * a33 - a13 * a13 AS c22, a12 * a13 - a11 * a23 AS c23, a11 * a22 - a12 * a12 AS c33 FROM moments),
solved AS (
  SELECT *, (c11 * t1 + c12 * t2 + c13 * t3) / (a11 * c11 + a12 * c12 + a13 * c13) AS b1,
         (c12 * t1 + c22 * t2 + c23 * t3) / (a11 * c11 + a12 * c12 + a13 * c13) AS b2,
         (c13 * t1 + c23 * t2 + c33 * t3) / (a11 * c11 + a12 * c12 + a13 * c13) AS b3 FROM cofactors),
fit AS (SELECT my - b1 * m1 - b2 * m2 - b3 * m3 AS b0, b1, b2, b3 FROM solved)
"""


WORD_OR_PUNCT = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"


def normalise(e: str) -> str:
    return f"array_to_string({words(f'lower({e})')}, ' ')"


def sentences(e: str) -> str:
    marked = f"regexp_replace({e}, '([.!?])\\s+', '\\1' || chr(1), 'g')"
    return (f"list_filter(list_transform(string_split({marked}, chr(1)), lambda s: trim(s)), "
            f"lambda s: s <> '')")
