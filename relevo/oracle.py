"""DuckDB SQL that states each registered query independently of the Spark code.

Tables are the driver's views (lineitem, part, documents, labels, ...). DuckDB's regex engine
(RE2) has no vertical tab in ``\\s``; the cleaned text keeps Java's whitespace set, so the SQL
spells that set out. Integer widths and doubles are cast to the Spark result types.
"""

from __future__ import annotations

# Java's \s: space, \t, \n, vertical tab, \f, \r.
WS = r"[ \t\n\v\f\r]"
CLEAN_RE = r"[^a-zA-Z1-9 \t\n\v\f\r]"


def clean(x: str) -> str:
    return f"regexp_replace({x}, '{CLEAN_RE}', '', 'g')"


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({x}), '{WS}+'), lambda t: t <> '')"


def glue(x: str) -> str:
    return f"regexp_replace(lower({x}), '{WS}+', '', 'g')"


def ml_tokens(x: str) -> str:
    """ML Tokenizer: split on single whitespace, trailing empties dropped, '' -> [''], blank -> []."""
    low = f"lower({x})"
    trimmed = f"regexp_replace({low}, '{WS}+$', '')"
    return (f"(CASE WHEN {low} = '' THEN [''] WHEN {trimmed} = '' THEN []::VARCHAR[] "
            f"ELSE regexp_split_to_array({trimmed}, '{WS}') END)")


PAIRS = """
pairs AS (
  SELECT l.id, l.product_uid,
         concat_ws(' ', p.p_brand, p.p_type, p.p_name) AS product_title,
         CASE l.id % 3 WHEN 0 THEN s.p_name
                       WHEN 1 THEN concat_ws(' ', s.p_name, s.p_type)
                       ELSE concat_ws(' ', s.p_brand, s.p_name, s.p_type) END AS search_term,
         l.relevance
  FROM (SELECT l_orderkey * 10 + l_linenumber AS id, min(l_partkey) AS product_uid,
               min(l_suppkey) AS sk, round(1 + 20 * min(l_discount), 2) AS relevance
        FROM lineitem GROUP BY 1) l
  JOIN part p ON p.p_partkey = l.product_uid
  JOIN part s ON s.p_partkey = l.sk
)"""

TRAIN = "train AS (SELECT * FROM pairs WHERE id % 5 <> 0)"
TEST = "test AS (SELECT id, product_uid, product_title, search_term FROM pairs WHERE id % 5 = 0)"
DESCRIPTIONS = "descriptions AS (SELECT doc_id AS product_uid, text AS product_description FROM documents)"
ATTRIBUTES = """
attributes AS (
  SELECT p_partkey AS product_uid, 'brand' AS name, p_brand AS value FROM part
  UNION ALL SELECT p_partkey, 'size', CAST(p_size AS VARCHAR) FROM part
  UNION ALL SELECT p_partkey, 'type', p_type FROM part
)"""


def with_(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(c.strip() for c in ctes) + "\n"


def hit_features_sql(pairs_table: str = "pairs", name: str = "features") -> str:
    return f"""
{name}_hits AS (
  SELECT q.*, {words(clean("coalesce(q.search_term, '')"))} AS terms,
         {glue(clean("coalesce(q.product_title, '')"))} AS title_blob,
         coalesce({glue(clean('d.product_description'))}, 'empty') AS desc_blob
  FROM {pairs_table} q LEFT JOIN descriptions d ON d.product_uid = q.product_uid
),
{name} AS (
  SELECT * EXCLUDE (terms, title_blob, desc_blob, product_title, search_term),
         CAST(len(terms) AS INTEGER) AS term_len,
         CAST(len(list_filter(terms, lambda t: contains(title_blob, t))) AS INTEGER) AS tf_title,
         CAST(len(list_filter(terms, lambda t: contains(desc_blob, t))) AS INTEGER) AS tf_desc
  FROM {name}_hits
)"""


# The default English stop words of StopWordsRemover, in its order.
ENGLISH_STOP_WORDS = tuple("""
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers
herself it its itself they them their theirs themselves what which who whom this that these those am is are
was were be been being have has had having do does did doing a an the and but if or because as until while of
at by for with about against between into through during before after above below to from up down in out on
off over under again further then once here there when where why how all any both each few more most other
some such no nor not only own same so than too very s t can will just don should now i'll you'll he'll she'll
we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're they're i've we've you've
they've isn't aren't wasn't weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't
mustn't can't couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
""".split())

ATTR_FLAT_SPACE = """
attr_flat AS (
  SELECT product_uid, string_agg(value, ' ' ORDER BY name, value) AS attr_list
  FROM attributes GROUP BY product_uid
)"""

ATTR_FLAT_COMMA = """
attr_values AS (
  SELECT product_uid, string_agg(value, ',' ORDER BY name, value) AS value_list
  FROM attributes GROUP BY product_uid
)"""

TOKENS = f"""
doc_tokens AS (
  SELECT doc_id, {ml_tokens("coalesce(text, '')")} AS tok FROM documents
)"""

# Ordinary least squares on (term_len, tf_title, tf_desc) of the train rows, by population
# covariances and Cramer's rule.
OLS = """
moments AS (
  SELECT covar_pop(term_len, term_len) c11, covar_pop(term_len, tf_title) c12,
         covar_pop(term_len, tf_desc) c13, covar_pop(tf_title, tf_title) c22,
         covar_pop(tf_title, tf_desc) c23, covar_pop(tf_desc, tf_desc) c33,
         covar_pop(term_len, relevance) b1, covar_pop(tf_title, relevance) b2,
         covar_pop(tf_desc, relevance) b3,
         avg(term_len) m1, avg(tf_title) m2, avg(tf_desc) m3, avg(relevance) my
  FROM train_features
),
det AS (
  SELECT *, c11 * (c22 * c33 - c23 * c23) - c12 * (c12 * c33 - c23 * c13)
            + c13 * (c12 * c23 - c22 * c13) AS d FROM moments
),
beta AS (
  SELECT (b1 * (c22 * c33 - c23 * c23) - c12 * (b2 * c33 - c23 * b3) + c13 * (b2 * c23 - c22 * b3)) / d AS w1,
         (c11 * (b2 * c33 - b3 * c23) - b1 * (c12 * c33 - c23 * c13) + c13 * (c12 * b3 - b2 * c13)) / d AS w2,
         (c11 * (c22 * b3 - c23 * b2) - c12 * (c12 * b3 - b2 * c13) + b1 * (c12 * c23 - c22 * c13)) / d AS w3,
         m1, m2, m3, my
  FROM det
),
ols AS (
  SELECT w1, w2, w3, my - w1 * m1 - w2 * m2 - w3 * m3 AS w0 FROM beta
)"""


def elastic_net(reg: float, alpha: float, source: str = "train_features", name: str = "enet") -> str:
    """The elastic-net solution on (term_len, tf_title, tf_desc): coordinate descent on the standardised
    moments, written out as a recursion; ``name`` has (w0, w1, w2, w3)."""

    def step(b: str, rest: str) -> str:
        z = f"({b} - ({rest}))"
        return f"sign({z}) * greatest(abs({z}) - l1, 0) / (1 + l2)"

    return f"""
{name}_m AS (
  SELECT stddev_pop(term_len) s1, stddev_pop(tf_title) s2, stddev_pop(tf_desc) s3, stddev_pop(relevance) sy,
         corr(term_len, tf_title) c12, corr(term_len, tf_desc) c13, corr(tf_title, tf_desc) c23,
         corr(term_len, relevance) b1, corr(tf_title, relevance) b2, corr(tf_desc, relevance) b3,
         avg(term_len) m1, avg(tf_title) m2, avg(tf_desc) m3, avg(relevance) my,
         {alpha}::DOUBLE * {reg}::DOUBLE / stddev_pop(relevance) AS l1, (1 - {alpha}::DOUBLE) * {reg}::DOUBLE / stddev_pop(relevance) AS l2
  FROM {source}
),
{name}_steps(i, u1, u2, u3) AS (
  SELECT 0, 0::DOUBLE, 0::DOUBLE, 0::DOUBLE
  UNION ALL
  SELECT i + 1, v1, v2, {step('b3', 'c13 * v1 + c23 * v2')}
  FROM (SELECT *, {step('b2', 'c12 * v1 + c23 * u3')} AS v2
        FROM (SELECT *, {step('b1', 'c12 * u2 + c13 * u3')} AS v1 FROM {name}_steps, {name}_m WHERE i < 400))
),
{name} AS (
  SELECT my - u1 * sy / s1 * m1 - u2 * sy / s2 * m2 - u3 * sy / s3 * m3 AS w0, u1 * sy / s1 AS w1, u2 * sy / s2 AS w2, u3 * sy / s3 AS w3
  FROM {name}_steps, {name}_m WHERE i = 400
)"""


#: The best single split on (term_len, tf_title, tf_desc): the largest fall of the squared error, over the
#: middles between neighbouring distinct values.
STUMP = """
stump_rows AS (
  SELECT 'term_len' AS feature, 1 AS place, CAST(term_len AS DOUBLE) AS x, relevance AS y FROM train_features
  UNION ALL SELECT 'tf_title', 2, tf_title, relevance FROM train_features
  UNION ALL SELECT 'tf_desc', 3, tf_desc, relevance FROM train_features
),
stump_values AS (SELECT feature, place, x, count(*) AS n, sum(y) AS s FROM stump_rows GROUP BY ALL),
stump_cuts AS (
  SELECT feature, place, (x + lead(x) OVER w) / 2 AS threshold, sum(n) OVER w AS nl, sum(s) OVER w AS sl,
         sum(n) OVER (PARTITION BY feature) AS n, sum(s) OVER (PARTITION BY feature) AS s
  FROM stump_values WINDOW w AS (PARTITION BY feature ORDER BY x)
),
stump AS (
  SELECT feature, threshold, sl / nl AS "left", (s - sl) / (n - nl) AS "right"
  FROM stump_cuts WHERE threshold IS NOT NULL
  ORDER BY sl * sl / nl + (s - sl) * (s - sl) / (n - nl) DESC, place, threshold LIMIT 1
)"""
