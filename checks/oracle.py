"""DuckDB SQL with the expected result of each registered query."""

from __future__ import annotations

from stacklens.functions.text import TOKEN_PATTERN, load_stop_words
from stacklens.schemas import AGE_GROUPS, DEVICE_TYPES, EVENT_TYPES, LOAN_STATUSES, MEMBERSHIP_TYPES, TRANSACTION_TYPES
from stacklens.sources.testdata import DRIFT_SPLIT, GENRES, HOLDOUT_START, SCORE_SPLIT


def r(expr: str, digits: int) -> str:
    """Round half up on the decimal value."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38,{12 if digits > 4 else digits + 5})), {digits}) AS DOUBLE)"


def pick(index: str, labels: list[str]) -> str:
    return f"CASE {index} " + " ".join(f"WHEN {i} THEN '{x}'" for i, x in enumerate(labels)) + " END"


def in_list(labels: list[str]) -> str:
    return "(" + ", ".join(f"'{x}'" for x in labels) + ")"


SEASON = ("CASE WHEN month({0}) IN (12, 1, 2) THEN 'winter' WHEN month({0}) <= 5 THEN 'spring' "
          "WHEN month({0}) <= 8 THEN 'summer' ELSE 'fall' END")
TIME_OF_DAY = "CASE WHEN hour({0}) < 12 THEN 'morning' WHEN hour({0}) < 17 THEN 'afternoon' ELSE 'evening' END"
DOW = "CAST(isodow({0}) - 1 AS INTEGER)"

# Named parts, each usable as a CTE; the value lists the parts it builds on.
PARTS: dict[str, tuple[str, tuple[str, ...]]] = {}


def part(name: str, sql: str, *needs: str) -> None:
    PARTS[name] = (sql, needs)


def with_parts(body: str, *needs: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        for n in PARTS[name][1]:
            visit(n)
        if name not in ordered:
            ordered.append(name)

    for n in needs:
        visit(n)
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({PARTS[n][0]})" for n in ordered)
    return f"WITH {ctes}\n{body}" if ordered else body


# --- source tables ------------------------------------------------------------------------

def _loans(status: str, returned: str) -> str:
    return f"""
SELECT printf('P%05d', o.o_custkey) AS patron_id, printf('B%05d', l.l_partkey) AS book_id,
  p.p_name AS book_title, p.p_type AS genre, CAST(o.o_orderdate AS TIMESTAMP) AS checkout_date,
  {returned} AS return_date, {status} AS loan_status,
  CAST(l.l_quantity AS INTEGER) AS loan_duration_days, CAST((l.l_linenumber - 1) % 5 AS INTEGER) AS times_renewed,
  {pick('c.c_nationkey % 5', AGE_GROUPS)} AS patron_age_group,
  {pick('c.c_custkey % 3', MEMBERSHIP_TYPES)} AS patron_membership_type
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part p ON p.p_partkey = l.l_partkey JOIN customer c ON c.c_custkey = o.o_custkey"""


part("loans", _loans(
    "CASE l.l_returnflag WHEN 'A' THEN 'returned' WHEN 'R' THEN 'overdue' WHEN 'N' THEN 'lost' END",
    "CAST(o.o_orderdate AS TIMESTAMP) + to_days(CAST(l.l_quantity AS INTEGER))",
))
part("loans_dirty", _loans(
    "CASE l.l_returnflag WHEN 'A' THEN 'returned' WHEN 'R' THEN 'overdue' ELSE l.l_returnflag END",
    "CAST(l.l_shipdate AS TIMESTAMP)",
))
part("pos", f"""
SELECT printf('T%06d', o_orderkey) AS transaction_id, printf('P%05d', o_custkey) AS patron_id,
  CAST(o_orderdate AS TIMESTAMP) AS transaction_date,
  {pick("CAST(o_orderpriority[1] AS INTEGER) - 1", TRANSACTION_TYPES)} AS transaction_type,
  o_totalprice AS amount,
  CASE o_orderstatus WHEN 'F' THEN 'card' WHEN 'O' THEN 'cash' WHEN 'P' THEN 'mobile' END AS payment_method,
  CAST(o_orderkey % 3 + 1 AS INTEGER) AS items_purchased FROM orders""")


def _activity(error: str) -> str:
    return f"""
SELECT printf('E%08d', event_id) AS event_id, printf('P%05d', user_id) AS patron_id,
  CASE event_type WHEN 'click' THEN 'book_search' WHEN 'view' THEN 'book_view'
    WHEN 'signup' THEN CASE WHEN event_id % 2 = 1 THEN 'session_end' ELSE 'session_start' END
    WHEN 'purchase' THEN CASE WHEN event_id % 2 = 1 THEN 'reservation_cancel' ELSE 'reservation_made' END
    WHEN 'error' THEN {error} END AS event_type,
  CAST(ts AS TIMESTAMP) AS event_timestamp,
  CASE WHEN event_type <> 'signup' THEN printf('B%05d', CAST(json_extract(props, '$.k') AS BIGINT)) END AS book_id,
  'S' || CAST(user_id AS VARCHAR) || strftime(CAST(ts AS TIMESTAMP), '%Y%m%d') AS session_id,
  {pick('event_id % 3', DEVICE_TYPES)} AS device_type, props AS event_metadata FROM events"""


part("activity", _activity("CASE WHEN event_id % 2 = 1 THEN 'review_submitted' ELSE 'wishlist_add' END"))
part("activity_raw", _activity("'error'"))
part("request_log", "SELECT CAST(ts AS TIMESTAMP) AS request_ts, event_type AS endpoint, value AS latency_ms FROM events")
part("recommend_requests", """
SELECT c_custkey AS request_id,
  CASE WHEN c_custkey % 40 = 7 THEN '  ' WHEN c_custkey % 40 = 8 THEN 'X' || CAST(c_custkey AS VARCHAR)
    ELSE ' ' || printf('P%05d', c_custkey) || ' ' END AS patron_id,
  CAST(c_custkey % 53 AS INTEGER) AS n_recommendations, c_custkey % 4 <> 3 AS exclude_seen,
  CASE WHEN c_custkey % 10 <> 9 THEN CAST(c_custkey % 12 AS INTEGER) END AS diversity_cap FROM customer""")
part("similar_requests", """
SELECT p_partkey AS request_id,
  CASE WHEN p_partkey % 30 = 4 THEN 'X' || CAST(p_partkey AS VARCHAR) ELSE printf('B%05d', p_partkey) END AS book_id,
  CAST(p_partkey % 13 AS INTEGER) AS n_similar,
  CASE WHEN p_partkey % 5 = 0 THEN 'word2vec' WHEN p_partkey % 5 < 3 THEN 'tfidf' ELSE 'bert' END AS method FROM part""")
part("vectors", "SELECT printf('B%05d', vec_id) AS book_id, CAST(embedding AS DOUBLE[]) AS vector FROM embeddings")
part("pairs", "SELECT DISTINCT patron_id, book_id FROM loans", "loans")


def mode_of(table: str, key: str, value: str, name: str, where: str = "TRUE") -> str:
    return f"""SELECT {key}, v AS {name} FROM (
  SELECT {key}, v, row_number() OVER (PARTITION BY {key} ORDER BY n DESC, v) AS rn FROM (
    SELECT {key}, {value} AS v, count(*) AS n FROM {table} WHERE {where} GROUP BY ALL) WHERE v IS NOT NULL) WHERE rn = 1"""


# --- validation ---------------------------------------------------------------------------

def _check(source: str, check: str, failed: str, label: str, table: str) -> str:
    return f"""SELECT '{source}' AS source, '{check}' AS "check", failed, failed = 0 AS passed,
  CAST(failed AS VARCHAR) || ' {label}' AS detail FROM (SELECT CAST({failed} AS BIGINT) AS failed FROM {table})"""


def _invalid(column: str, labels: list[str]) -> str:
    return f"count(*) FILTER (WHERE NOT coalesce({column} IN {in_list(labels)}, FALSE))"


CHECKS = {
    "loans": [
        _check("loans", "no_null_patron_ids", "count(*) FILTER (WHERE patron_id IS NULL)", "null patron ids", "loans_dirty"),
        _check("loans", "return_after_checkout", "count(*) FILTER (WHERE return_date < checkout_date)",
               "loans returned before checkout", "loans_dirty"),
        _check("loans", "positive_loan_duration", "count(*) FILTER (WHERE loan_duration_days <= 0)",
               "loans with a duration of 0 or less", "loans_dirty"),
        _check("loans", "valid_loan_status", _invalid("loan_status", LOAN_STATUSES), "loans with an unknown status", "loans_dirty"),
        _check("loans", "non_negative_renewals", "count(*) FILTER (WHERE times_renewed < 0)",
               "loans with negative renewals", "loans_dirty"),
    ],
    "pos": [
        _check("pos", "no_duplicate_transactions", "count(*) - count(DISTINCT transaction_id)", "repeated transaction ids", "pos"),
        _check("pos", "no_negative_amounts", "count(*) FILTER (WHERE amount < 0)", "sales with a negative amount", "pos"),
        _check("pos", "valid_transaction_types", _invalid("transaction_type", TRANSACTION_TYPES), "sales of an unknown type", "pos"),
        _check("pos", "positive_items_purchased", "count(*) FILTER (WHERE items_purchased <= 0)", "sales without items", "pos"),
    ],
    "activity": [
        _check("activity", "no_duplicate_events", "count(*) - count(DISTINCT event_id)", "repeated event ids", "activity"),
        _check("activity", "valid_event_types", _invalid("event_type", EVENT_TYPES), "events of an unknown type", "activity"),
        _check("activity", "no_null_patron_ids", "count(*) FILTER (WHERE patron_id IS NULL)", "null patron ids", "activity"),
    ],
}


def _cross(loans: str) -> list[str]:
    def missing(table: str, check: str) -> str:
        return _check("cross_source", check, "count(*)", f"patrons of {table} without loans",
                      f"(SELECT DISTINCT patron_id FROM {table} WHERE patron_id NOT IN (SELECT patron_id FROM {loans}))")

    day = "strftime({0}, '%Y-%m-%d')"
    return [
        missing("pos", "pos_patrons_in_lms"), missing("activity", "activity_patrons_in_lms"),
        f"""SELECT 'cross_source' AS source, 'date_range_overlap' AS "check",
  CAST(CASE WHEN p0 <= l1 AND p1 >= l0 THEN 0 ELSE 1 END AS BIGINT) AS failed, p0 <= l1 AND p1 >= l0 AS passed,
  'loans ' || {day.format('l0')} || ' to ' || {day.format('l1')} || ', pos ' || {day.format('p0')} || ' to ' || {day.format('p1')} AS detail
FROM (SELECT min(checkout_date) AS l0, max(checkout_date) AS l1 FROM {loans}),
  (SELECT min(transaction_date) AS p0, max(transaction_date) AS p1 FROM pos)""",
    ]


CHECKED_REQUESTS = """SELECT request_id, trim(patron_id) AS patron_id, n_recommendations, exclude_seen,
  coalesce(diversity_cap, 3) AS diversity_cap,
  CASE WHEN length(patron_id) BETWEEN 1 AND 20 AND trim(patron_id) <> '' AND n_recommendations BETWEEN 1 AND 50
    AND coalesce(diversity_cap, 3) BETWEEN 1 AND 10 THEN 'ok' ELSE 'invalid' END AS status FROM recommend_requests"""
CHECKED_SIMILAR = """SELECT request_id, book_id, n_similar, method,
  CASE WHEN n_similar BETWEEN 1 AND 50 AND method IN ('tfidf', 'bert') THEN 'ok' ELSE 'invalid' END AS status
FROM similar_requests"""
part("checked_requests", CHECKED_REQUESTS, "recommend_requests")
part("checked_similar", CHECKED_SIMILAR, "similar_requests")


# --- patron features ----------------------------------------------------------------------

def temporal(name: str, source: str, where: str = "TRUE") -> None:
    """Parts for the temporal features of a slice of the loans."""
    ts = "checkout_date"
    part(f"{name}_src", f"SELECT * FROM loans WHERE {where}", "loans")
    part(f"{name}_ref", f"SELECT max({ts}) AS m FROM {name}_src", f"{name}_src")
    modes = {
        "dow": ("preferred_day_of_week", DOW.format(ts)),
        "month": ("preferred_month", f"CAST(month({ts}) AS INTEGER)"),
        "season": ("preferred_season", SEASON.format(ts)),
        "tod": ("preferred_time_of_day", TIME_OF_DAY.format(ts)),
    }
    for short, (column, expr) in modes.items():
        part(f"{name}_{short}", mode_of(f"{name}_src", "patron_id", expr, column), f"{name}_src")
    trailing = ", ".join(
        f"count(*) FILTER (WHERE {ts} >= (SELECT m FROM {name}_ref) - to_days({n})) AS checkouts_last_{n}d"
        for n in (30, 60, 90)
    )
    part(name, f"""
SELECT b.patron_id, n AS total_checkouts, datesub('day', last, (SELECT m FROM {name}_ref)) AS days_since_last_checkout,
  datesub('day', first, last) AS tenure_days, {r('duration', 2)} AS avg_loan_duration_days,
  {r('renewals', 3)} AS avg_renewals_per_checkout, {r('weekend / n', 3)} AS weekend_borrow_ratio,
  preferred_day_of_week, preferred_month, preferred_season, preferred_time_of_day,
  checkouts_last_30d, checkouts_last_60d, checkouts_last_90d,
  {r("n / CASE WHEN datesub('day', first, last) = 0 THEN 1.0::DOUBLE ELSE datesub('day', first, last) / 30.0::DOUBLE END", 3)} AS monthly_borrow_rate,
  {r('overdue / n', 3)} AS overdue_rate
FROM (SELECT patron_id, count(book_id) AS n, max({ts}) AS last, min({ts}) AS first, avg(loan_duration_days) AS duration,
    avg(times_renewed) AS renewals, count(*) FILTER (WHERE isodow({ts}) >= 6) AS weekend,
    count(*) FILTER (WHERE loan_status = 'overdue') AS overdue, {trailing}
  FROM {name}_src GROUP BY patron_id) b
JOIN {name}_dow USING (patron_id) JOIN {name}_month USING (patron_id)
JOIN {name}_season USING (patron_id) JOIN {name}_tod USING (patron_id)""",
         f"{name}_ref", *[f"{name}_{s}" for s in modes])


temporal("temporal", "loans")
temporal("temporal_before", "loans", f"checkout_date < TIMESTAMP '{DRIFT_SPLIT}'")
temporal("temporal_after", "loans", f"checkout_date >= TIMESTAMP '{DRIFT_SPLIT}'")

GENRE_COUNTS = [f"genre_{g.lower().replace(' ', '_')}_count" for g in GENRES]
part("genre_rows", "SELECT patron_id, genre, count(book_id) AS n FROM loans WHERE genre IS NOT NULL GROUP BY ALL", "loans")
part("genre_feat", f"""
SELECT patron_id, {', '.join(f"CAST(coalesce(sum(n) FILTER (WHERE genre = '{g}'), 0) AS BIGINT) AS {c}" for g, c in zip(GENRES, GENRE_COUNTS))},
  count(*) AS genre_diversity, min(genre) FILTER (WHERE rn = 1) AS top_genre, {r('max(n) / sum(n)', 3)} AS genre_concentration
FROM (SELECT *, row_number() OVER (PARTITION BY patron_id ORDER BY n DESC, genre) AS rn FROM genre_rows) GROUP BY patron_id""",
     "genre_rows")
part("payment_mode", mode_of("pos", "patron_id", "payment_method", "preferred_payment"), "pos")
part("spending", f"""
SELECT patron_id, {r('spend', 2)} AS total_spend, total_pos_transactions, {r('spend / total_pos_transactions', 2)} AS avg_transaction_value,
  {r('largest', 2)} AS max_single_transaction, {', '.join(f"{r(f's_{t}', 2)} AS spend_{t}" for t in TRANSACTION_TYPES)},
  is_event_buyer, is_donor, preferred_payment
FROM (SELECT patron_id, {r('sum(amount)', 6)} AS spend, count(amount) AS total_pos_transactions, max(amount) AS largest,
  {', '.join(f"coalesce(sum(amount) FILTER (WHERE transaction_type = '{t}'), 0) AS s_{t}" for t in TRANSACTION_TYPES)},
  CAST(max(CASE WHEN transaction_type = 'event_ticket' THEN 1 ELSE 0 END) AS INTEGER) AS is_event_buyer,
  CAST(max(CASE WHEN transaction_type = 'donation' THEN 1 ELSE 0 END) AS INTEGER) AS is_donor
  FROM pos GROUP BY patron_id) JOIN payment_mode USING (patron_id)""", "pos", "payment_mode")
part("device_mode", mode_of("activity", "patron_id", "device_type", "preferred_device"), "activity")


def _ratio(top: str, bottom: str, digits: int) -> str:
    return f"CASE WHEN {bottom} = 0 THEN 0.0::DOUBLE ELSE {r(f'{top} / {bottom}', digits)} END"


COUNTED = ("book_search", "book_view", "wishlist_add", "reservation_made", "review_submitted")
part("engagement", f"""
SELECT patron_id, total_events, {', '.join(f'count_{t}' for t in COUNTED)},
  {_ratio('count_wishlist_add', 'count_book_view', 3)} AS wishlist_conversion_rate,
  {_ratio('count_reservation_made', 'count_book_search', 3)} AS reservation_rate,
  CASE WHEN count_review_submitted > 0 THEN 1 ELSE 0 END AS is_reviewer, preferred_device, total_sessions,
  {_ratio('total_events', 'total_sessions', 2)} AS events_per_session
FROM (SELECT patron_id, count(event_id) AS total_events,
  {', '.join(f"count(*) FILTER (WHERE event_type = '{t}') AS count_{t}" for t in COUNTED)},
  count(*) FILTER (WHERE event_type = 'session_start') AS total_sessions FROM activity GROUP BY patron_id)
JOIN device_mode USING (patron_id)""", "activity", "device_mode")

SPENDING_COLUMNS = ["total_spend", "total_pos_transactions", "avg_transaction_value", "max_single_transaction",
                    *[f"spend_{t}" for t in TRANSACTION_TYPES], "is_event_buyer", "is_donor"]
ENGAGEMENT_COLUMNS = ["total_events", *[f"count_{t}" for t in COUNTED], "wishlist_conversion_rate", "reservation_rate",
                      "is_reviewer", "total_sessions", "events_per_session"]
_filled = [f"coalesce({c}, 0) AS {c}" for c in [*GENRE_COUNTS, "genre_diversity", "genre_concentration",
                                              *SPENDING_COLUMNS, *ENGAGEMENT_COLUMNS]]
_named = [f"coalesce({c}, 'unknown') AS {c}" for c in ("top_genre", "preferred_payment", "preferred_device")]
part("behavioral", f"""
SELECT patron_id, {', '.join(_filled + _named)} FROM (SELECT DISTINCT patron_id FROM loans) u
LEFT JOIN genre_feat USING (patron_id) LEFT JOIN spending USING (patron_id) LEFT JOIN engagement USING (patron_id)""",
     "loans", "genre_feat", "spending", "engagement")

# --- books --------------------------------------------------------------------------------

FIRST = "first({0} ORDER BY checkout_date, {0}) FILTER (WHERE {0} IS NOT NULL) AS {0}"


def _catalog(source: str) -> str:
    return f"""SELECT book_id, {FIRST.format('book_title')}, {FIRST.format('genre')}, count(patron_id) AS total_borrows
FROM {source} GROUP BY book_id"""


part("catalog", _catalog("loans"), "loans")
part("metadata", f"""
SELECT book_id, {FIRST.format('book_title')}, {FIRST.format('genre')}, count(patron_id) AS total_borrows,
  count(DISTINCT patron_id) AS unique_borrowers, {r('avg(loan_duration_days)', 2)} AS avg_loan_duration,
  {r('avg(times_renewed)', 3)} AS avg_renewals,
  {r("avg(CASE WHEN loan_status = 'overdue' THEN 1 ELSE 0 END)", 3)} AS overdue_rate FROM loans GROUP BY book_id""", "loans")
TIER = """CASE WHEN total_borrows <= (SELECT quantile_cont(total_borrows, 0.1) FROM {0}) THEN 'low'
  WHEN total_borrows <= (SELECT quantile_cont(total_borrows, 0.9) FROM {0}) THEN 'medium' ELSE 'high' END AS popularity_tier"""
part("patron_dim", """
SELECT patron_id, first(patron_age_group ORDER BY checkout_date, patron_age_group) AS patron_age_group,
  first(patron_membership_type ORDER BY checkout_date, patron_membership_type) AS patron_membership_type
FROM loans GROUP BY patron_id""", "loans")

# --- text ---------------------------------------------------------------------------------

STOP_WORDS = "[" + ", ".join(f"'{w}'" for w in load_stop_words()) + "]"
WORDS = f"list_filter(regexp_extract_all(lower(text), '{TOKEN_PATTERN}'), lambda t: NOT list_contains({STOP_WORDS}, t))"


def text_parts(name: str, docs: str, key: str, max_features: int, min_df: int, *needs: str) -> None:
    """Parts <name>_words, _counts, _vocab, _weights of a corpus."""
    part(f"{name}_words", f"SELECT {key}, {WORDS} AS words FROM ({docs})", *needs)
    grams = "list_concat(words, [words[i] || ' ' || words[i + 1] for i in range(1, len(words))])"
    part(f"{name}_counts", f"SELECT {key}, term, count(*) AS tf FROM (SELECT {key}, unnest({grams}) AS term FROM {name}_words) GROUP BY ALL",
         f"{name}_words")
    part(f"{name}_vocab", f"""SELECT term, CAST(sum(tf) AS BIGINT) AS corpus_count, count(*) AS df FROM {name}_counts
GROUP BY term HAVING count(*) >= {min_df} ORDER BY corpus_count DESC, term LIMIT {max_features}""", f"{name}_counts")
    part(f"{name}_weights", f"""SELECT {key}, term, w / sqrt(sum(w * w) OVER (PARTITION BY {key})) AS weight FROM (
  SELECT {key}, term, tf * (ln((1.0::DOUBLE + (SELECT count(*) FROM {name}_words)) / (1.0::DOUBLE + df)) + 1.0::DOUBLE) AS w
  FROM {name}_counts JOIN {name}_vocab USING (term))""", f"{name}_counts", f"{name}_vocab")


BOOK_DOCS = "SELECT book_id, book_title || ' ' || genre || ' ' || genre || ' ' || genre AS text FROM catalog"
for _n in (50, 100, 200, 500):
    text_parts(f"books{_n}", BOOK_DOCS, "book_id", _n, 1, "catalog")
text_parts("documents500", "SELECT doc_id, text FROM documents", "doc_id", 500, 2)


def text_scores(n: int, pairs: str = "pairs", catalog: str = "catalog", suffix: str = "") -> None:
    """Profiles and the cosine of every patron and book."""
    w = f"books{n}_weights"
    part(f"profile{n}{suffix}", f"""SELECT patron_id, term, s / n_books AS weight FROM (
  SELECT patron_id, term, sum(weight) AS s FROM {pairs} JOIN {w} USING (book_id) GROUP BY ALL)
JOIN (SELECT patron_id, count(*) AS n_books FROM {pairs} GROUP BY patron_id) USING (patron_id)""", pairs, w)
    part(f"cos{n}{suffix}", f"""SELECT u.patron_id, c.book_id, {r('coalesce(dot / norm, 0)', 9)} AS score
FROM (SELECT DISTINCT patron_id FROM {pairs}) u CROSS JOIN {catalog} c
LEFT JOIN (SELECT p.patron_id, w.book_id, sum(p.weight * w.weight) AS dot FROM profile{n}{suffix} p JOIN {w} w USING (term) GROUP BY ALL) d
  ON d.patron_id = u.patron_id AND d.book_id = c.book_id
LEFT JOIN (SELECT patron_id, sqrt(sum(weight * weight)) AS norm FROM profile{n}{suffix} GROUP BY patron_id) l ON l.patron_id = u.patron_id""",
         f"profile{n}{suffix}", catalog)


for _n in (200, 500):
    text_scores(_n)


def best(table: str, n: int, unseen: bool = True, pairs: str = "pairs") -> str:
    """Top n rows per patron of (patron_id, book_id, score)."""
    source = f"{table} ANTI JOIN {pairs} USING (patron_id, book_id)" if unseen else table
    return f"""SELECT patron_id, book_id, {r('score', 4)} AS score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY patron_id ORDER BY score DESC, book_id) AS rank FROM {source}) WHERE rank <= {n}"""


part("similar500", f"""
SELECT book_id, similar_book_id, {r('score', 4)} AS score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY score DESC, similar_book_id) AS rank FROM (
    SELECT a.book_id, b.book_id AS similar_book_id, {r('coalesce(dot, 0)', 9)} AS score
    FROM catalog a JOIN catalog b ON a.book_id <> b.book_id
    LEFT JOIN (SELECT x.book_id AS l, y.book_id AS m, sum(x.weight * y.weight) AS dot
      FROM books500_weights x JOIN books500_weights y USING (term) GROUP BY ALL) ON l = a.book_id AND m = b.book_id)) WHERE rank <= 10""",
     "catalog", "books500_weights")
part("similar200", PARTS["similar500"][0].replace("books500", "books200").replace("rank <= 10", "rank <= 50"),
     "catalog", "books200_weights")

# --- embeddings ---------------------------------------------------------------------------

part("recency", """
SELECT patron_id, book_id, CASE WHEN n = 1 THEN 1.0::DOUBLE
  ELSE (0.5::DOUBLE + 0.5::DOUBLE * (place - 1) / (n - 1)) / (0.75::DOUBLE * n) END AS weight
FROM (SELECT *, row_number() OVER (PARTITION BY patron_id ORDER BY latest, book_id) AS place,
    count(*) OVER (PARTITION BY patron_id) AS n
  FROM (SELECT patron_id, book_id, max(checkout_date) AS latest FROM loans GROUP BY ALL) JOIN vectors USING (book_id))""",
     "loans", "vectors")


def embedding_parts(recency: str, suffix: str = "") -> None:
    part(f"emb_profile{suffix}", f"""
SELECT patron_id, dim, sum(weight * x) / sum(weight) AS value FROM (
  SELECT patron_id, weight, unnest(vector) AS x, generate_subscripts(vector, 1) - 1 AS dim FROM {recency} JOIN vectors USING (book_id))
GROUP BY ALL""", recency, "vectors")
    part(f"emb_cos{suffix}", f"""
SELECT p.patron_id, v.book_id, {r('list_cosine_similarity(p.v, v.vector)', 9)} AS score
FROM (SELECT patron_id, list(value ORDER BY dim) AS v FROM emb_profile{suffix} GROUP BY patron_id) p CROSS JOIN vectors v""",
         f"emb_profile{suffix}", "vectors")


embedding_parts("recency")


def _emb_similar(n: int) -> str:
    return f"""SELECT book_id, similar_book_id, {r('score', 4)} AS score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY score DESC, similar_book_id) AS rank FROM (
    SELECT a.book_id, b.book_id AS similar_book_id, {r('list_cosine_similarity(a.vector, b.vector)', 9)} AS score
    FROM vectors a JOIN vectors b ON a.book_id <> b.book_id)) WHERE rank <= {n}"""


# --- ranking and hybrid -------------------------------------------------------------------

part("strength", """SELECT patron_id, book_id, CAST(least(count(loan_status) + 0.5 * sum(times_renewed), 5) AS DOUBLE) AS interaction_score
FROM loans GROUP BY ALL""", "loans")
_plain = [f"('0x' || substr(md5(book_id || '|{j}|42'), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS f{j}" for j in range(2)]
part("plain_start", f"SELECT book_id, {', '.join(_plain)} FROM (SELECT DISTINCT book_id FROM strength)", "strength")


def ridge_half(name: str, key: str, other: str, factors: str) -> None:
    """Part ``name``: (key, f0, f1), the two equations of each key with ridge 0.1 solved by determinants."""
    part(name, f"""SELECT {key}, (c * r0 - b * r1) / (a * c - b * b) AS f0, (a * r1 - b * r0) / (a * c - b * b) AS f1 FROM (
  SELECT {key}, sum(f0 * f0) + 0.1::DOUBLE AS a, sum(f0 * f1) AS b, sum(f1 * f1) + 0.1::DOUBLE AS c,
    sum(f0 * interaction_score) AS r0, sum(f1 * interaction_score) AS r1
  FROM strength JOIN {factors} USING ({other}) WHERE interaction_score > 0 GROUP BY {key})""", "strength", factors)


ridge_half("plain_u1", "patron_id", "book_id", "plain_start")
ridge_half("plain_v1", "book_id", "patron_id", "plain_u1")
ridge_half("plain_u", "patron_id", "book_id", "plain_v1")
ridge_half("plain_v", "book_id", "patron_id", "plain_u")
part("plain_dot", f"""SELECT patron_id, book_id, {r('u.f0 * v.f0 + u.f1 * v.f1', 9)} AS score FROM plain_u u CROSS JOIN plain_v v""", "plain_u", "plain_v")
part("plain_like", f"""SELECT a.book_id, b.book_id AS similar_book_id,
  {r('(a.f0 * b.f0 + a.f1 * b.f1) / sqrt((a.f0 * a.f0 + a.f1 * a.f1) * (b.f0 * b.f0 + b.f1 * b.f1))', 9)} AS score
FROM plain_v a JOIN plain_v b ON a.book_id <> b.book_id""", "plain_v")
part("popular", """SELECT u.patron_id, c.book_id, CAST(total_borrows AS DOUBLE) AS score
FROM (SELECT DISTINCT patron_id FROM pairs) u CROSS JOIN catalog c""", "pairs", "catalog")
part("train", f"SELECT * FROM loans WHERE checkout_date < TIMESTAMP '{HOLDOUT_START}'", "loans")
part("holdout", f"SELECT * FROM loans WHERE checkout_date >= TIMESTAMP '{HOLDOUT_START}'", "loans")
part("train_pairs", "SELECT DISTINCT patron_id, book_id FROM train", "train")
part("train_catalog", _catalog("train"), "train")
part("train_popular", """SELECT u.patron_id, c.book_id, CAST(total_borrows AS DOUBLE) AS score
FROM (SELECT DISTINCT patron_id FROM train_pairs) u CROSS JOIN train_catalog c""", "train_pairs", "train_catalog")
part("train_popular_all", """SELECT u.patron_id, c.book_id, CAST(total_borrows AS DOUBLE) AS score
FROM (SELECT printf('P%05d', c_custkey) AS patron_id FROM customer) u CROSS JOIN train_catalog c""", "train_catalog")
part("train_popular_top", best("train_popular", 10, pairs="train_pairs"), "train_popular", "train_pairs")
part("train_recency", PARTS["recency"][0].replace("FROM loans", "FROM train"), "train", "vectors")
embedding_parts("train_recency", "_train")
part("train_emb_top", best("emb_cos_train", 10, pairs="train_pairs"), "emb_cos_train", "train_pairs")
part("relevant", "SELECT DISTINCT patron_id, book_id FROM holdout", "holdout")


def _hits(top: str) -> str:
    return f"""SELECT patron_id, n_relevant, coalesce(hits, 0) AS hits, coalesce(dcg, 0) AS dcg
FROM (SELECT patron_id, count(*) AS n_relevant FROM relevant GROUP BY patron_id)
LEFT JOIN (SELECT patron_id, count(*) AS hits, sum(1.0::DOUBLE / log2(rank + 1)) AS dcg
  FROM {top} JOIN relevant USING (patron_id, book_id) GROUP BY patron_id) USING (patron_id)"""


part("hits", _hits("train_popular_top"), "relevant", "train_popular_top")
part("emb_hits", _hits("train_emb_top"), "relevant", "train_emb_top")


def candidate_parts(name: str, lists: dict[str, tuple[str, bool]], weights: dict[str, float], extra: str = "") -> None:
    """Parts <name>, <name>_norm, _fused, _scored over (model → (score table, unseen only))."""
    needs = ["pairs", *[t for t, _ in lists.values()]]
    part(name, " UNION ALL ".join(f"SELECT *, '{m}' AS model FROM ({best(t, 50, unseen)})" for m, (t, unseen) in lists.items()), *needs)
    part(f"{name}_norm", f"""SELECT *, CASE WHEN hi = lo THEN 1.0::DOUBLE ELSE (score - lo) / (hi - lo) END AS normalized_score FROM (
  SELECT *, min(score) OVER w AS lo, max(score) OVER w AS hi FROM {name} WINDOW w AS (PARTITION BY patron_id, model))""", name)
    weight = "CASE model " + " ".join(f"WHEN '{m}' THEN {w}::DOUBLE" for m, w in weights.items()) + " END"
    part(f"{name}_fused", f"""SELECT patron_id, book_id, {r(r(f'sum({weight} * normalized_score)', 9), 4)} AS fused_score
FROM {name}_norm GROUP BY ALL""", f"{name}_norm")
    part(f"{name}_scored", f"""SELECT patron_id, book_id, genre, {r('''fused_score
    + coalesce(CASE WHEN most > 0 THEN 0.05::DOUBLE * total_borrows / most ELSE 0 END, 0)
    + CASE WHEN genre = modal_genre THEN 0.02::DOUBLE ELSE 0 END''', 9)} AS combined_score FROM (
  SELECT *, max(total_borrows) OVER (PARTITION BY patron_id) AS most FROM {name}_fused
  LEFT JOIN catalog USING (book_id) LEFT JOIN top_genre USING (patron_id))""", f"{name}_fused", "catalog", "top_genre")


part("top_genre", mode_of("loans", "patron_id", "genre", "modal_genre"), "loans")
candidate_parts("cand", {"popular": ("popular", True), "tfidf": ("cos200", True), "embedding": ("emb_cos", True)},
                {"popular": 0.6, "tfidf": 0.2, "embedding": 0.2})
candidate_parts("unseen", {"tfidf": ("cos200", True), "embedding": ("emb_cos", True)}, {"tfidf": 0.5, "embedding": 0.5})
candidate_parts("anybook", {"tfidf": ("cos200", False), "embedding": ("emb_cos", False)}, {"tfidf": 0.5, "embedding": 0.5})


def capped(table: str, cap: int, n: int) -> str:
    return f"""SELECT patron_id, book_id, genre, combined_score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY patron_id ORDER BY combined_score DESC, book_id) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY patron_id, genre ORDER BY combined_score DESC, book_id) AS place FROM {table})
  WHERE place <= {cap}) WHERE rank <= {n}"""


def explained(targets: str, prefix: str = "") -> str:
    text = ("CASE WHEN signals IS NOT NULL THEN 'Recommended because your reading history matches ''' || genre || "
            "''' content — key signals: ' || signals ELSE 'Recommended based on genre match: ' || genre END")
    return f"""SELECT t.patron_id, t.book_id, {f"'{prefix}' || " if prefix else ''}{text} AS explanation
FROM (SELECT DISTINCT patron_id, book_id FROM {targets}) t JOIN catalog USING (book_id)
LEFT JOIN (SELECT patron_id, book_id, string_agg(term, ', ' ORDER BY place) AS signals FROM (
    SELECT *, row_number() OVER (PARTITION BY patron_id, book_id ORDER BY product DESC, term) AS place FROM (
      SELECT t.patron_id, t.book_id, term, {r('w.weight * p.weight', 9)} AS product
      FROM (SELECT DISTINCT patron_id, book_id FROM {targets}) t
      JOIN books200_weights w USING (book_id) JOIN profile200 p USING (patron_id, term)) WHERE product > 0)
  WHERE place <= 5 GROUP BY ALL) s ON s.patron_id = t.patron_id AND s.book_id = t.book_id"""


part("tfidf_top3", best("cos200", 3), "cos200", "pairs")
part("popular_top3", best("popular", 3), "popular", "pairs")
part("popular_top10", best("popular", 10), "popular", "pairs")

# --- drift --------------------------------------------------------------------------------

IS_BASE = f"checkout_date < TIMESTAMP '{DRIFT_SPLIT}'"


def psi_parts(name: str, long_base: str, long_current: str, by: str, *needs: str) -> None:
    """Parts <name>_base, _cur (feature, value), _edges, and <name> with psi terms per feature."""
    keys = f"{by}, feature" if by else "feature"
    part(f"{name}_base", long_base, *needs)
    part(f"{name}_cur", long_current, *needs)
    part(f"{name}_edges", f"""SELECT feature, quantile_cont(value, [{', '.join(f'{i / 10}' for i in range(1, 10))}]) AS e,
  count(*) AS nb, avg(value) AS mb FROM {name}_base GROUP BY feature""", f"{name}_base")
    part(f"{name}_bins", f"""
SELECT *, nb_bin + 1e-6::DOUBLE AS b, nc_bin + 1e-6::DOUBLE AS c FROM (
  SELECT k.*, bin, coalesce(x.n, 0) AS nb_bin, coalesce(y.n, 0) AS nc_bin FROM (
    SELECT {keys}, count(*) AS nc, avg(value) AS mc FROM {name}_cur GROUP BY ALL) k CROSS JOIN range(10) s(bin)
  LEFT JOIN (SELECT feature, len(list_filter(e, lambda q: q <= value)) AS bin, count(*) AS n FROM {name}_base JOIN {name}_edges USING (feature) GROUP BY ALL) x USING (feature, bin)
  LEFT JOIN (SELECT {keys}, len(list_filter(e, lambda q: q <= value)) AS bin, count(*) AS n FROM {name}_cur JOIN {name}_edges USING (feature) GROUP BY ALL) y USING ({keys}, bin))""",
         f"{name}_edges", f"{name}_cur", f"{name}_base")


def psi_result(name: str, by: str = "", smoothing: float = 1e-5) -> str:
    keys = f"{by}, feature" if by else "feature"
    b, c = f"(b / (nb + {smoothing!r}::DOUBLE))", f"(c / (nc + {smoothing!r}::DOUBLE))"
    return f"""SELECT {keys}, {r('raw', 4)} AS psi,
  CASE WHEN raw < 0.1 THEN 'OK' WHEN raw < 0.2 THEN 'WARNING' ELSE 'CRITICAL' END AS status,
  {r('mb', 4)} AS baseline_mean, {r('mc', 4)} AS current_mean, {r('mc - mb', 4)} AS mean_shift
FROM (SELECT {keys}, any_value(mb) AS mb, any_value(mc) AS mc, {r(f'sum(({c} - {b}) * ln({c} / {b}))', 9)} AS raw
  FROM {name}_bins JOIN {name}_edges USING (feature) GROUP BY ALL)"""


def _long(table: str, features, where: str, by: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT {by + ', ' if by else ''}'{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM {table} WHERE {where} AND {f} IS NOT NULL"
        for f in features)


NUMERIC = ("loan_duration_days", "times_renewed")
psi_parts("psi", _long("loans", NUMERIC, IS_BASE), _long("loans", NUMERIC, f"NOT ({IS_BASE})"), "", "loans")
part("loans_day", "SELECT *, CAST(checkout_date AS DATE) AS day, date_trunc('month', checkout_date)::TIMESTAMP AS month FROM loans", "loans")
psi_parts("psi_day", _long("loans", NUMERIC, IS_BASE), _long("loans_day", NUMERIC, f"NOT ({IS_BASE})", "day"), "day", "loans", "loans_day")
psi_parts("psi_month", _long("loans", NUMERIC, IS_BASE), _long("loans_day", NUMERIC, f"NOT ({IS_BASE})", "month"), "month", "loans", "loans_day")
MONITORED = ("total_checkouts", "days_since_last_checkout", "tenure_days", "avg_loan_duration_days",
             "avg_renewals_per_checkout", "weekend_borrow_ratio")
psi_parts("psi_feat", _long("temporal_before", MONITORED, "TRUE"), _long("temporal_after", MONITORED, "TRUE"), "",
          "temporal_before", "temporal_after")
part("events_day", "SELECT CAST(ts AS DATE) AS day, ts, value FROM events")
psi_parts("psi_value", _long("events_day", ("value",), f"ts < TIMESTAMP '{SCORE_SPLIT}'"), _long("events_day", ("value",), "TRUE", "day"),
          "day", "events_day")
part("psi_rows", psi_result("psi"), "psi_bins", "psi_edges")
part("psi_feat_rows", f"""SELECT feature, psi, CASE WHEN psi > 0.2 THEN 'CRITICAL' WHEN psi > 0.1 THEN 'WARNING' ELSE 'OK' END AS flag
FROM ({psi_result('psi_feat', smoothing=0.0)})""", "psi_feat_bins", "psi_feat_edges")
part("months", f"""SELECT month, {r(r('avg(psi)', 9), 4)} AS overall_psi,
  datesub('day', TIMESTAMP '{DRIFT_SPLIT}', month) AS days_since_training
FROM ({psi_result('psi_month', 'month')}) GROUP BY month""", "psi_month_bins", "psi_month_edges")
part("scores", f"SELECT least(value / 500, 1.0::DOUBLE) AS score, ts < TIMESTAMP '{SCORE_SPLIT}' AS is_base FROM events")
part("kl", f"""
SELECT {r('kl', 4)} AS kl_divergence, CASE WHEN kl > 0.15 THEN 'CRITICAL' WHEN kl > 0.105 THEN 'WARNING' ELSE 'OK' END AS status,
  {r('mb', 4)} AS baseline_score_mean, {r('mc', 4)} AS current_score_mean, {r('sb', 4)} AS baseline_score_std, {r('sc', 4)} AS current_score_std
FROM (SELECT {r('sum(q * ln(q / p))', 9)} AS kl FROM (
    SELECT (coalesce(nb, 0) + 1e-6::DOUBLE) / (sum(coalesce(nb, 0)) OVER () + 2e-5::DOUBLE) AS p,
      (coalesce(nc, 0) + 1e-6::DOUBLE) / (sum(coalesce(nc, 0)) OVER () + 2e-5::DOUBLE) AS q
    FROM range(20) s(bin) LEFT JOIN (
      SELECT len(list_filter([CAST(i AS DOUBLE) * 0.05::DOUBLE for i in range(1, 20)], lambda e: e <= greatest(least(score, 1), 0))) AS bin,
        count(*) FILTER (WHERE is_base) AS nb, count(*) FILTER (WHERE NOT is_base) AS nc FROM scores GROUP BY ALL) USING (bin))),
  (SELECT avg(score) FILTER (WHERE is_base) AS mb, avg(score) FILTER (WHERE NOT is_base) AS mc,
    stddev_pop(score) FILTER (WHERE is_base) AS sb, stddev_pop(score) FILTER (WHERE NOT is_base) AS sc FROM scores)""", "scores")
part("categories", " UNION ALL ".join(
    f"SELECT '{f}' AS feature, {f} AS category, count(*) FILTER (WHERE {IS_BASE}) AS base, count(*) FILTER (WHERE NOT {IS_BASE}) AS cur FROM loans GROUP BY ALL"
    for f in ("genre", "loan_status", "patron_membership_type")), "loans")
_SHARES = """SELECT feature, category, sum(cur + 1e-6::DOUBLE) OVER w AS tc,
  (base + 1e-6::DOUBLE) / sum(base + 1e-6::DOUBLE) OVER w AS p, (cur + 1e-6::DOUBLE) / sum(cur + 1e-6::DOUBLE) OVER w AS q
FROM {t} WINDOW w AS (PARTITION BY feature)"""
part("shares", _SHARES.format(t="categories"), "categories")
part("book_categories", f"""SELECT 'book_id' AS feature, book_id AS category, count(*) FILTER (WHERE {IS_BASE}) AS base,
  count(*) FILTER (WHERE NOT {IS_BASE}) AS cur FROM loans GROUP BY ALL""", "loans")
part("book_shares", _SHARES.format(t="book_categories"), "book_categories")


def chi2(scale: str, shares: str = "shares", terms: int = 400) -> str:
    """Upper tail by the incomplete gamma series, summed in the log domain; far in the tail it is 0."""
    term = "(q - p) * (q - p) / p" + (" * tc" if scale == "counts" else "")
    return f"""SELECT feature, {r('stat', 4)} AS chi2_statistic, dof, {r('p_raw', 6)} AS p_value, {r('p_raw', 9)} < 0.05 AS drift_detected,
  CASE WHEN {r('p_raw', 9)} < 0.05 THEN 'CRITICAL' ELSE 'OK' END AS status
FROM (SELECT feature, stat, dof, CASE WHEN stat > 2 * dof + 200 THEN 0 ELSE greatest(1 - (SELECT sum(exp(-stat / 2 + (dof / 2.0::DOUBLE + k) * ln(stat / 2)
    - lgamma(dof / 2.0::DOUBLE + k + 1))) FROM range({terms}) s(k)), 0) END AS p_raw
  FROM (SELECT feature, sum({term}) AS stat, count(*) - 1 AS dof FROM {shares} GROUP BY feature))"""


part("chi2_rows", chi2("counts"), "shares")
part("report", """SELECT 'numeric' AS kind, feature, psi AS value, status FROM psi_rows
UNION ALL SELECT 'categorical', feature, chi2_statistic, status FROM chi2_rows
UNION ALL SELECT 'prediction', 'score', kl_divergence, status FROM kl""", "psi_rows", "chi2_rows", "kl")


def _health(name: str, table: str, ts: str) -> str:
    return f"""SELECT '{name}' AS "table", 'has_rows' AS "check", count(*) > 0 AS passed FROM {table}
UNION ALL SELECT '{name}', 'fresh', coalesce((epoch_us(TIMESTAMP '2001-11-04 12:00:00') - epoch_us(max({ts}))) / 3.6e9 < 26, FALSE) FROM {table}"""


part("health", " UNION ALL ".join([
    _health("loans", "loans", "checkout_date"), _health("pos", "pos", "transaction_date"),
    _health("activity", "activity", "event_timestamp"),
    _health("returns", "loans", "return_date"),
]), "loans", "pos", "activity")
part("health_row", f"""SELECT count(*) FILTER (WHERE passed) AS passed, count(*) AS total,
  {r('count(*) FILTER (WHERE passed) / count(*)', 4)} AS health_score FROM health""", "health")


def diversity(table: str, by: str = "") -> str:
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""SELECT {keys}CAST(sum(n) AS BIGINT) AS n_recommendations, first(genre ORDER BY n DESC, genre) AS top_genre,
  {r('max(n) / sum(n)', 6)} AS top_genre_ratio, {r('1 - max(n) / sum(n)', 6)} AS diversity_score,
  {r('1 - max(n) / sum(n)', 9)} >= 0.3 AS diversity_ok
FROM (SELECT {keys}genre, count(*) AS n FROM {table} WHERE genre IS NOT NULL GROUP BY ALL) {group}"""


part("popular_genres", "SELECT * FROM popular_top10 JOIN catalog USING (book_id)", "popular_top10", "catalog")
part("diversity_row", diversity("popular_genres"), "popular_genres")


def _percentiles(value: str, minutes: int, probs: dict[str, float]) -> str:
    at = ", ".join(f"max(v) FILTER (WHERE rn = greatest(ceil({p} * n), 1)) AS {c}" for c, p in probs.items())
    return f"""SELECT window_start, max(n) AS n, {at} FROM (
  SELECT window_start, v, row_number() OVER (PARTITION BY window_start ORDER BY v) AS rn, count(*) OVER (PARTITION BY window_start) AS n
  FROM (SELECT time_bucket(INTERVAL {minutes} MINUTE, request_ts, TIMESTAMP '1970-01-01')::TIMESTAMP AS window_start, {value} AS v FROM request_log))
GROUP BY window_start"""


MINUTE = "date_trunc('minute', request_ts)::TIMESTAMP"


def oracle_sql() -> dict[str, str]:
    w = with_parts
    documents_words = f"SELECT doc_id, {WORDS} AS words FROM documents"
    terms50 = "books50_vocab"
    sql = {
        "load_loans": w("SELECT * FROM loans", "loans"),
        "load_loans_csv": w("SELECT * FROM loans", "loans"),
        "feature_etl": w("SELECT * FROM temporal JOIN behavioral USING (patron_id)", "temporal", "behavioral"),
        "incremental_etl_master": w("SELECT * FROM temporal JOIN behavioral USING (patron_id)", "temporal", "behavioral"),
        "load_pos": w("SELECT * FROM pos", "pos"),
        "load_pos_csv": w("SELECT * FROM pos", "pos"),
        "load_activity_csv": w("SELECT * FROM activity", "activity"),
        "load_activity": w("SELECT * FROM activity", "activity"),
        "stream_equals_batch": w("SELECT * FROM activity", "activity"),
        "activity_metadata": w("SELECT event_id, CAST(json_extract(event_metadata, '$.k') AS INTEGER) AS k FROM activity", "activity"),
        "validate_loans": w(" UNION ALL ".join(CHECKS["loans"]), "loans_dirty"),
        "validate_pos": w(" UNION ALL ".join(CHECKS["pos"]), "pos"),
        "validate_activity": w(" UNION ALL ".join(CHECKS["activity"]), "activity"),
        "validate_cross_source": w(" UNION ALL ".join(_cross("loans")), "loans", "pos", "activity"),
        "validate_all": w(" UNION ALL ".join([*CHECKS["loans"], *CHECKS["pos"], *CHECKS["activity"], *_cross("loans_dirty")]),
                          "loans_dirty", "pos", "activity"),
        "validate_requests": w("SELECT * FROM checked_requests", "checked_requests"),
        "validate_similar_requests": w("SELECT * FROM checked_similar", "checked_similar"),
        "calendar_fields": w(f"""SELECT patron_id, book_id, checkout_date, {DOW.format('checkout_date')} AS checkout_dayofweek,
  CAST(month(checkout_date) AS INTEGER) AS checkout_month, CAST(hour(checkout_date) AS INTEGER) AS checkout_hour,
  CASE WHEN isodow(checkout_date) >= 6 THEN 1 ELSE 0 END AS is_weekend, {SEASON.format('checkout_date')} AS season,
  {TIME_OF_DAY.format('checkout_date')} AS time_of_day FROM loans""", "loans"),
        "temporal_features": w("SELECT * FROM temporal", "temporal"),
        "patron_modes": w(f"""SELECT patron_id, modal_genre, modal_day_of_week, modal_status FROM top_genre
JOIN ({mode_of('loans', 'patron_id', DOW.format('checkout_date'), 'modal_day_of_week')}) USING (patron_id)
JOIN ({mode_of('loans', 'patron_id', 'loan_status', 'modal_status')}) USING (patron_id)""", "top_genre", "loans"),
        "genre_features": w("SELECT * FROM genre_feat", "genre_feat"),
        "spending_features": w("SELECT * FROM spending", "spending"),
        "engagement_features": w("SELECT * FROM engagement", "engagement"),
        "stream_engagement": w("SELECT * FROM engagement", "engagement"),
        "behavioral_features": w("SELECT * FROM behavioral", "behavioral"),
        "master_features": w("SELECT * FROM temporal JOIN behavioral USING (patron_id)", "temporal", "behavioral"),
        "patron_universe": w("SELECT DISTINCT patron_id FROM loans", "loans"),
        "patron_dim": w("SELECT * FROM patron_dim", "patron_dim"),
        "book_catalog": w("SELECT * FROM catalog", "catalog"),
        "book_metadata": w("SELECT * FROM metadata", "metadata"),
        "content_text": w("""SELECT book_id, book_title || ' ' || genre || ' ' || genre || ' ' || genre AS content_text,
  'A ' || genre || ' book titled ' || book_title AS sentence FROM catalog""", "catalog"),
        "popularity_tiers": w(f"SELECT book_id, total_borrows, {TIER.format('catalog')} FROM catalog", "catalog"),
        "genre_encoding": w(f"""SELECT book_id, {', '.join(f"CASE WHEN genre = '{g}' THEN 1 ELSE 0 END AS genre_{g}" for g in GENRES)},
  {TIER.format('metadata')}, {r('total_borrows / (SELECT max(total_borrows) FROM metadata)', 4)} AS popularity_score,
  avg_renewals AS engagement_score, overdue_rate FROM metadata""", "metadata"),
        "kpis": w(f"""SELECT count(DISTINCT patron_id) AS active_patrons, count(DISTINCT book_id) AS books, count(*) AS total_checkouts,
  {r('avg(loan_duration_days)', 1)} AS avg_loan_days, {r("avg(CASE WHEN loan_status = 'overdue' THEN 1 ELSE 0 END)", 4)} AS overdue_rate
FROM loans""", "loans"),
        "weekly_checkouts": w("SELECT date_trunc('week', checkout_date)::TIMESTAMP AS week, count(*) AS checkouts FROM loans GROUP BY ALL", "loans"),
        "genre_counts": w('SELECT genre, count(*) AS "count" FROM loans GROUP BY ALL', "loans"),
        "membership_counts": w('SELECT patron_membership_type, count(*) AS "count" FROM patron_dim GROUP BY ALL', "patron_dim"),
        "age_counts": w('SELECT patron_age_group, count(*) AS "count" FROM patron_dim GROUP BY ALL', "patron_dim"),
        "dow_counts": w("""SELECT CAST(i AS INTEGER) AS position, day, checkouts FROM (
  SELECT unnest(range(7)) AS i, unnest(['Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday', 'Sunday']) AS day)
LEFT JOIN (SELECT dayname(checkout_date) AS day, count(*) AS checkouts FROM loans GROUP BY ALL) USING (day)""", "loans"),
        "top_patrons": w(f"""SELECT patron_id, count(book_id) AS checkouts, count(DISTINCT book_id) AS unique_books,
  {r('avg(loan_duration_days)', 2)} AS avg_duration, count(*) FILTER (WHERE loan_status = 'overdue') AS overdue_count
FROM loans GROUP BY patron_id ORDER BY checkouts DESC, patron_id LIMIT 10""", "loans"),
        "top_books": w(f"""SELECT book_id, genre, count(patron_id) AS borrows, count(DISTINCT patron_id) AS unique_patrons,
  {r('avg(times_renewed)', 2)} AS avg_renewals FROM loans GROUP BY book_id, genre ORDER BY borrows DESC, book_id LIMIT 15""", "loans"),
        "genre_trend": w("""SELECT date_trunc('month', checkout_date)::TIMESTAMP AS month, genre, count(*) AS checkouts FROM loans
WHERE genre IN (SELECT genre FROM loans GROUP BY genre ORDER BY count(*) DESC, genre LIMIT 5) GROUP BY ALL""", "loans"),
        "season_genre": w(f"""SELECT upper(s[1]) || s[2:] AS season, genre, count(*) AS checkouts
FROM (SELECT {SEASON.format('checkout_date')} AS s, genre FROM loans) GROUP BY ALL""", "loans"),
        "patron_history": w("""SELECT book_id, book_title, genre, checkout_date, loan_duration_days, loan_status FROM loans
WHERE patron_id = (SELECT patron_id FROM loans GROUP BY patron_id ORDER BY count(*) DESC, patron_id LIMIT 1)
ORDER BY checkout_date DESC, book_id, loan_duration_days, loan_status LIMIT 20""", "loans"),
        "tokens": f"""SELECT doc_id, CAST(unnest(range(len(words))) AS INTEGER) AS position, unnest(words) AS token FROM ({documents_words})""",
        "ngrams": w("SELECT * FROM documents500_counts", "documents500_counts"),
        "tfidf_vocab": w("SELECT * FROM books100_vocab", "books100_vocab"),
        "tfidf_weights": w(f"SELECT book_id, term, {r('weight', 6)} AS weight FROM books100_weights", "books100_weights"),
        "tfidf_vocab_documents": w("SELECT * FROM documents500_vocab", "documents500_vocab"),
        "tfidf_weights_documents": w(f"SELECT doc_id, term, {r('weight', 6)} AS weight FROM documents500_weights", "documents500_weights"),
        "tfidf_profile": w(f"SELECT patron_id, term, {r('weight', 6)} AS weight FROM profile200", "profile200"),
        "tfidf_recommend": w(best("cos500", 10), "cos500", "pairs"),
        "tfidf_similar": w("SELECT * FROM similar500", "similar500"),
        "tfidf_explain": w(explained("tfidf_top3"), "tfidf_top3", "catalog", "books200_weights", "profile200"),
        "hybrid_explain_content": w(explained("popular_top3", "Recommended because: "), "popular_top3", "catalog", "books200_weights", "profile200"),
        "interaction_strength": w("SELECT * FROM strength", "strength"),
        "interaction_stats": w(f"""SELECT count(DISTINCT patron_id) AS n_patrons, count(DISTINCT book_id) AS n_books, count(*) AS n_filled,
  {r('count(*) * 100.0::DOUBLE / (count(DISTINCT patron_id) * count(DISTINCT book_id))', 4)} AS density_pct FROM strength""", "strength"),
        "als_plain_factors": w(f"""SELECT 'patron' AS side, patron_id AS id, {r('f0', 6)} AS f0, {r('f1', 6)} AS f1 FROM plain_u
UNION ALL SELECT 'book', book_id, {r('f0', 6)}, {r('f1', 6)} FROM plain_v""", "plain_u", "plain_v"),
        "als_plain_recommend": w(best("plain_dot", 10), "plain_dot", "pairs"),
        "als_plain_similar": w(f"""SELECT book_id, similar_book_id, {r('score', 4)} AS score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY score DESC, similar_book_id) AS rank FROM plain_like) WHERE rank <= 10""", "plain_like"),
        "als_plain_loss": w(f"""SELECT count(*) FILTER (WHERE s IS NOT NULL) AS n_filled, {r('sqrt(avg((s - p) * (s - p)) FILTER (WHERE s IS NOT NULL))', 4)} AS observed_rmse,
  {r('sqrt(var_pop(s))', 4)} AS mean_predictor_rmse, {r('avg((coalesce(s, 0) - p) * (coalesce(s, 0) - p))', 4)} AS full_matrix_mse
FROM (SELECT interaction_score AS s, u.f0 * v.f0 + u.f1 * v.f1 AS p FROM plain_u u CROSS JOIN plain_v v
  LEFT JOIN strength t ON t.patron_id = u.patron_id AND t.book_id = v.book_id)""", "plain_u", "plain_v", "strength"),
        "exclude_seen": w("SELECT * FROM relevant ANTI JOIN train_pairs USING (patron_id, book_id)", "relevant", "train_pairs"),
        "topn_popular_cold": w(best("train_popular_all", 10, pairs="train_pairs"), "train_popular_all", "train_pairs"),
        "topn_popular_unseen": w("SELECT * FROM popular_top10", "popular_top10"),
        "candidates": w("SELECT * FROM cand", "cand"),
        "minmax_normalise": w(f"SELECT patron_id, book_id, score, rank, model, {r('normalized_score', 6)} AS normalized_score FROM cand_norm", "cand_norm"),
        "fuse_scores": w("SELECT * FROM cand_fused", "cand_fused"),
        "apply_rules": w(f"SELECT patron_id, book_id, genre, {r('combined_score', 6)} AS combined_score FROM cand_scored", "cand_scored"),
        "diversity_cap": w(capped("(SELECT patron_id, book_id, genre, interaction_score AS combined_score FROM strength JOIN catalog USING (book_id))", 2, 8),
                           "strength", "catalog"),
        "hybrid_recommend": w(f"SELECT patron_id, book_id, genre, {r('combined_score', 6)} AS combined_score, rank FROM ({capped('cand_scored', 3, 10)})",
                              "cand_scored"),
        "model_info": w(f"""SELECT component, weight, n_patrons, n_books FROM (
  SELECT 'als' AS component, {r('0.35::DOUBLE / 0.8', 6)} AS weight UNION ALL SELECT 'svd', {r('0.25::DOUBLE / 0.8', 6)}
  UNION ALL SELECT 'tfidf', {r('0.2::DOUBLE / 0.8', 6)}),
  (SELECT count(DISTINCT patron_id) AS n_patrons, count(DISTINCT book_id) AS n_books FROM strength)""", "strength"),
        "recency_weights": w(f"SELECT patron_id, book_id, {r('weight', 9)} AS weight FROM recency", "recency"),
        "emb_profile": w(f"SELECT patron_id, CAST(dim AS INTEGER) AS dim, {r('value', 6)} AS value FROM emb_profile", "emb_profile"),
        "emb_recommend": w(best("emb_cos", 10), "emb_cos", "pairs"),
        "emb_similar": w(_emb_similar(10), "vectors"),
        "emb_similar_lsh_recall": w(f"""SELECT count(DISTINCT book_id) AS books, count(*) AS pairs, TRUE AS recalled, CAST(0 AS BIGINT) AS wrong
FROM ({_emb_similar(10)})""", "vectors"),
        "side_feature_tokens": w("""SELECT 'patron' AS entity, patron_id AS id, 'age_group:' || patron_age_group AS feature FROM patron_dim
UNION ALL SELECT 'patron', patron_id, 'membership:' || patron_membership_type FROM patron_dim
UNION ALL SELECT 'book', book_id, 'genre:' || genre FROM catalog""", "patron_dim", "catalog"),
        "side_feature_weights": w("SELECT patron_id, book_id, CAST(sum(1 + 0.5 * times_renewed) AS DOUBLE) AS weight FROM loans GROUP BY ALL", "loans"),
        "precision_recall_at_k": w(f"""SELECT count(*) AS n_patrons, {r('avg(hits / 10.0::DOUBLE)', 6)} AS precision_at_k,
  {r('avg(hits / n_relevant)', 6)} AS recall_at_k FROM hits""", "hits"),
        "ndcg_at_k": w(f"""SELECT count(*) AS n_patrons, {r('''avg(dcg / (SELECT sum(1.0::DOUBLE / log2(i + 1))
  FROM range(1, 11) s(i) WHERE i <= n_relevant))''', 6)} AS ndcg_at_k FROM hits""", "hits"),
        "precision_over_time": w(f"""SELECT period, n_patrons, {r('coalesce(hits, 0) / (10.0::DOUBLE * n_patrons)', 6)} AS precision_at_k
FROM (SELECT date_trunc('month', checkout_date)::TIMESTAMP AS period, count(DISTINCT patron_id) AS n_patrons FROM holdout GROUP BY ALL)
LEFT JOIN (SELECT period, count(*) AS hits FROM (
    SELECT DISTINCT patron_id, book_id, date_trunc('month', checkout_date)::TIMESTAMP AS period FROM holdout)
  SEMI JOIN train_popular_top USING (patron_id, book_id) GROUP BY period) USING (period)""", "holdout", "train_popular_top"),
        "retrain_decision": w("SELECT *, overall_psi > 0.2 OR days_since_training > 42 AS drift_detected FROM months", "months"),
        "promote_decision": w(f"""SELECT challenger_score, champion_score, {r('challenger_score - champion_score', 6)} AS improvement,
  {r('challenger_score - champion_score', 9)} >= 0.01 OR champion_score = 0 AS promoted
FROM (SELECT {r('avg(hits / 10.0::DOUBLE)', 6)} AS challenger_score FROM hits),
  (SELECT {r('avg(hits / 10.0::DOUBLE)', 6)} AS champion_score FROM emb_hits)""", "hits", "emb_hits"),
        "psi_drift": w("SELECT * FROM psi_rows", "psi_rows"),
        "psi_drift_simple": w(f"SELECT feature, psi FROM ({psi_result('psi', smoothing=0.0)})", "psi_bins", "psi_edges"),
        "psi_by_day": w(psi_result("psi_day", "day"), "psi_day_bins", "psi_day_edges"),
        "stream_psi": w(psi_result("psi_value", "day"), "psi_value_bins", "psi_value_edges"),
        "kl_drift": w("SELECT * FROM kl", "kl"),
        "chi2_drift": w("SELECT * FROM chi2_rows", "chi2_rows"),
        "chi2_drift_books": w(chi2("counts", "book_shares", 20000), "book_shares"),
        "chi2_drift_proportion": w(chi2("proportion"), "shares"),
        "category_shifts": w(f"SELECT feature, category, {r(r('q - p', 9), 4)} AS shift FROM shares WHERE abs({r('q - p', 9)}) > 0.001", "shares"),
        "histogram_alignment": w(f"""SELECT feature, category, count(*) FILTER (WHERE base) AS base, count(*) FILTER (WHERE NOT base) AS cur
FROM (SELECT 'patron_id' AS feature, patron_id AS category, event_timestamp < TIMESTAMP '{SCORE_SPLIT}' AS base FROM activity
  UNION ALL SELECT 'book_id', book_id, event_timestamp < TIMESTAMP '{SCORE_SPLIT}' FROM activity) GROUP BY feature, category""", "activity"),
        "drift_report": w("SELECT * FROM report", "report"),
        "drift_summary": w(f"""SELECT CASE WHEN critical <> '' OR kl_critical THEN 'CRITICAL' WHEN warning <> '' THEN 'WARNING' ELSE 'OK' END AS overall_status,
  critical <> '' OR kl_critical AS retraining_recommended, overall_psi, critical AS critical_features, warning AS warning_features
FROM (SELECT coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (WHERE status = 'CRITICAL' AND kind <> 'prediction'), '') AS critical,
  coalesce(string_agg(feature, ',' ORDER BY feature) FILTER (WHERE status = 'WARNING' AND kind = 'numeric'), '') AS warning,
  bool_or(status = 'CRITICAL' AND kind = 'prediction') AS kl_critical,
  {r(r("avg(value) FILTER (WHERE kind = 'numeric')", 9), 4)} AS overall_psi FROM report)""", "report"),
        "feature_drift": w("SELECT * FROM psi_feat_rows", "psi_feat_rows"),
        "table_health": w("SELECT * FROM health", "health"),
        "health_score": w("SELECT * FROM health_row", "health_row"),
        "rec_diversity": w("SELECT * FROM diversity_row", "diversity_row"),
        "diversity_over_time": w(diversity("loans_day", "month"), "loans_day"),
        "system_status": w(f"""SELECT overall_psi, health_score, diversity_score,
  CASE WHEN overall_psi > 0.2 OR health_score < 0.7 OR diversity_score < 0.3 THEN 'CRITICAL'
    WHEN overall_psi > 0.1 OR health_score < 0.9 THEN 'WARNING' ELSE 'HEALTHY' END AS system_status, overall_psi > 0.2 AS retraining_recommended
FROM (SELECT {r(r('avg(psi)', 9), 4)} AS overall_psi FROM psi_feat_rows), (SELECT health_score FROM health_row),
  (SELECT diversity_score FROM diversity_row)""", "psi_feat_rows", "health_row", "diversity_row"),
        "recommend_batch": w(f"""SELECT q.request_id, q.patron_id, CASE WHEN status = 'ok' AND rank IS NULL THEN 'not_found' ELSE status END AS status,
  CAST(rank AS INTEGER) AS rank, book_id, genre, {r('combined_score', 6)} AS combined_score
FROM checked_requests q LEFT JOIN (
  SELECT request_id, book_id, genre, combined_score, n_recommendations, row_number() OVER (PARTITION BY request_id ORDER BY combined_score DESC, book_id) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY request_id, genre ORDER BY combined_score DESC, book_id) AS place
    FROM (SELECT * FROM checked_requests WHERE status = 'ok') JOIN (
      SELECT *, TRUE AS exclude_seen FROM unseen_scored UNION ALL SELECT *, FALSE FROM anybook_scored) USING (patron_id, exclude_seen))
  WHERE place <= diversity_cap QUALIFY rank <= n_recommendations) a ON a.request_id = q.request_id""",
                             "checked_requests", "unseen_scored", "anybook_scored"),
        "similar_batch": w(f"""SELECT q.request_id, q.book_id, q.method, CASE WHEN status = 'ok' AND rank IS NULL THEN 'not_found' ELSE status END AS status,
  rank, similar_book_id, score FROM checked_similar q LEFT JOIN (
  SELECT 'tfidf' AS method, * FROM similar200 UNION ALL SELECT 'bert', * FROM ({_emb_similar(50)})) n
  ON q.status = 'ok' AND n.method = q.method AND n.book_id = q.book_id AND n.rank <= q.n_similar""", "checked_similar", "similar200", "vectors"),
        "stream_quarantine": w(f"""SELECT CASE WHEN coalesce(event_type IN {in_list(EVENT_TYPES)}, FALSE) THEN 'valid' ELSE 'quarantine' END AS part,
  event_type, count(*) AS n FROM activity_raw GROUP BY ALL""", "activity_raw"),
        "windowed_rate": w(f"""SELECT {MINUTE} AS window_start, endpoint, count(*) AS requests, {r('count(*) / 60.0::DOUBLE', 6)} AS per_second
FROM request_log GROUP BY ALL""", "request_log"),
        "sliding_increase": w("""SELECT date_trunc('hour', request_ts)::TIMESTAMP - to_hours(h) AS window_start, endpoint, count(*) AS requests
FROM request_log, (SELECT unnest(range(24)) AS h) GROUP BY ALL""", "request_log"),
        "stream_windowed_rate": w(f"""SELECT {MINUTE} AS window_start, endpoint, count(*) AS requests, {r('count(*) / 60.0::DOUBLE', 6)} AS per_second
FROM request_log GROUP BY ALL""", "request_log"),
        "change_events": w(f"""
SELECT date_trunc('hour', m) AS window_start, endpoint, count(*) FILTER (WHERE v <> b) AS changes,
  sum(CASE WHEN b IS NULL THEN 0 WHEN v < b THEN v ELSE v - b END)::BIGINT AS increase
FROM (SELECT m, endpoint, v, lag(v) OVER (PARTITION BY endpoint ORDER BY m) AS b
  FROM (SELECT m, endpoint, sum(n) OVER (PARTITION BY endpoint, date_trunc('day', m) ORDER BY m) AS v
    FROM (SELECT {MINUTE} AS m, endpoint, count(*) AS n FROM request_log GROUP BY ALL)))
GROUP BY ALL""", "request_log"),
        # The exact percentile, moved to the middle of its bin (1 % on either side).
        "stream_percentiles": w("SELECT window_start, n, " + ", ".join(
            f"""{r(f"2 / (101 / 99.0::DOUBLE + 1) * pow(101 / 99.0::DOUBLE, ceil(ln({c}) / ln(101 / 99.0::DOUBLE)))", 6)} AS {c}"""
            for c in ("p50", "p95", "p99")) + " FROM (" + _percentiles("latency_ms", 5, {"p50": 0.5, "p95": 0.95, "p99": 0.99}) + ")", "request_log"),
        "windowed_percentiles": w(_percentiles("latency_ms", 5, {"p50": 0.5, "p95": 0.95, "p99": 0.99}), "request_log"),
        "score_percentiles": w(_percentiles("least(latency_ms / 500, 1.0::DOUBLE)", 10, {"p50": 0.5, "p90": 0.9}), "request_log"),
    }
    sql["stream_increase"], sql["stream_changes"] = sql["sliding_increase"], sql["change_events"]
    # The wide table cell by cell, zeros too.
    sql["tfidf_wide"] = w(f"""SELECT c.book_id, 'tfidf_' || v.term AS "column", coalesce({r('weight', 6)}, 0) AS value
FROM catalog c CROSS JOIN {terms50} v LEFT JOIN books50_weights w ON w.book_id = c.book_id AND w.term = v.term""",
                          "catalog", "books50_vocab", "books50_weights")
    lists = """count(DISTINCT {k}) AS n_lists, 10 * count(DISTINCT {k}) AS n_rows, 10 AS longest, TRUE AS ranks_run, TRUE AS scores_fall, 0 AS n_seen"""
    of_patrons, of_books = lists.format(k="patron_id"), lists.format(k="book_id")
    sql["als_properties"] = w(f"SELECT {of_patrons}, count(*) AS n_filled, TRUE AS beats_mean FROM strength", "strength")
    sql["svd_properties"] = w(f"SELECT {of_patrons}, 20 AS n_components, TRUE AS ratios_fit, TRUE AS values_fall FROM strength", "strength")
    sql["svd_similar_properties"] = w(f"SELECT {of_books} FROM strength", "strength")
    sql["side_feature_properties"] = f"SELECT {lists.format(k='c_custkey')} FROM customer"
    sql["side_feature_joint_properties"] = f"SELECT {lists.format(k='c_custkey')}, TRUE AS above_mean FROM customer"
    sql["hybrid_full_properties"] = w("""SELECT count(DISTINCT patron_id) AS n_lists, TRUE AS ranks_run, TRUE AS scores_fall, 0 AS n_seen,
  TRUE AS short_enough, TRUE AS cap_kept FROM strength""", "strength")
    sql["hybrid_explain_properties"] = w("""SELECT count(DISTINCT patron_id) AS n_patrons, 3 * count(DISTINCT patron_id) AS n_rows,
  TRUE AS all_have_reasons FROM strength""", "strength")
    part("hashed", """SELECT *, ('0x' || substr(md5(patron_id || '|' || book_id || '|' || CAST(CAST(epoch(checkout_date) AS BIGINT) AS VARCHAR)), 1, 8))::BIGINT % 100 < 80 AS is_train
FROM loans""", "loans")
    sql["holdout_split"] = w("""SELECT loan_status, CASE WHEN is_train THEN 'train' ELSE 'holdout' END AS part, count(*) AS n
FROM hashed GROUP BY ALL""", "hashed")
    sql["challenger_properties"] = w("""SELECT count(DISTINCT patron_id) AS n_patrons, TRUE AS has_score, TRUE AS ndcg_fits
FROM hashed WHERE NOT is_train AND patron_id IN (SELECT patron_id FROM hashed WHERE is_train)""", "hashed")
    sql["model_comparison_properties"] = w(f"""SELECT model, n_patrons, TRUE AS are_shares,
  CASE WHEN model = 'popularity' THEN p END AS precision_at_k, CASE WHEN model = 'popularity' THEN q END AS recall_at_k, CASE WHEN model = 'popularity' THEN g END AS ndcg_at_k
FROM (SELECT unnest(['popularity', 'tfidf', 'embedding', 'als', 'svd']) AS model),
  (SELECT count(*) AS n_patrons, {r('avg(hits / 10.0::DOUBLE)', 6)} AS p, {r('avg(hits / n_relevant)', 6)} AS q,
    {r('avg(dcg / (SELECT sum(1.0::DOUBLE / log2(i + 1)) FROM range(1, 11) s(i) WHERE i <= n_relevant))', 6)} AS g FROM hits)""", "hits")
    sql["recommend_batch_hybrid"] = w("""SELECT status, count(*) AS n_requests, TRUE AS size_kept, TRUE AS answered, TRUE AS cap_kept, TRUE AS exclude_kept
FROM (SELECT CASE WHEN status = 'ok' AND patron_id NOT IN (SELECT patron_id FROM pairs) THEN 'not_found' ELSE status END AS status
  FROM checked_requests) GROUP BY status""", "checked_requests", "pairs")
    sql["retrain_properties"] = w("""SELECT 1 AS n_versions, 'v1' AS champion, TRUE AS promoted, TRUE AS ran, FALSE AS ran_again,
  count(*) AS baseline_rows FROM loans""", "loans")
    asked = """SELECT request_id, trim(r.patron_id) AS patron_id, b.book_id FROM recommend_requests r
LEFT JOIN (SELECT patron_id, last(book_id ORDER BY checkout_date, book_id) AS book_id FROM loans GROUP BY patron_id) b ON b.patron_id = trim(r.patron_id)"""
    part("asked", asked, "recommend_requests", "loans")
    part("asked_known", "SELECT * FROM asked WHERE book_id IS NOT NULL", "asked")
    sql["explain_batch"] = w(f"""SELECT a.patron_id, a.book_id, request_id, explanation, CASE WHEN explanation IS NULL THEN 'not_found' ELSE 'ok' END AS status
FROM asked a LEFT JOIN ({explained('asked_known')}) e ON e.patron_id = a.patron_id AND e.book_id = a.book_id""",
                             "asked", "asked_known", "catalog", "books200_weights", "profile200")
    return sql
