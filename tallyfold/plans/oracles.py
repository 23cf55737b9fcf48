"""The named queries in SQL, for a cross-check by another engine."""

from __future__ import annotations

NOTICES = """
notices AS (
  SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS notice_id, l_orderkey AS contract_key, l_linenumber AS line,
    l_partkey AS part, l_suppkey AS company, o_custkey AS authority, c_nationkey AS nation,
    CASE WHEN l_returnflag = 'R' THEN 'can-modif' ELSE 'can-standard' END AS notice_type, CAST(l_shipdate AS DATE) AS pub_date, p_type AS division,
    l_extendedprice AS estimate, l_extendedprice * (1 - l_discount) * (CASE WHEN l_orderkey % 97 = 0 THEN 1000.0::DOUBLE ELSE 1.0::DOUBLE END) AS total,
    l_extendedprice * (1 + l_tax) AS payable, CASE WHEN l_linenumber % 4 > 0 THEN l_linenumber % 4 END AS bidders,
    l_orderkey % 97 = 0 AS low_confidence, CASE WHEN c_nationkey % 5 = 0 THEN 'PRT' ELSE 'POL' END AS country
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey)"""

CONTRACTS = NOTICES + """,
placed AS (
  SELECT *, row_number() OVER (PARTITION BY contract_key ORDER BY CASE WHEN notice_type = 'can-modif' THEN 1 ELSE 0 END,
      CASE WHEN notice_type = 'can-modif' THEN -datediff('day', DATE '1970-01-01', pub_date) ELSE datediff('day', DATE '1970-01-01', pub_date) END, line, part, company) = 1 AS is_current,
    first_value(total) OVER (PARTITION BY contract_key ORDER BY pub_date DESC, line DESC, part DESC, company DESC) AS newest
  FROM notices),
contracts AS (SELECT *, CASE WHEN is_current THEN newest ELSE total END AS current_value FROM placed)"""

TRUSTED = "round(sum(CASE WHEN is_current AND NOT low_confidence THEN current_value ELSE 0 END), 4) AS total_value, count(*) FILTER (is_current) AS contracts"

FILINGS = """
yearly AS (SELECT o_custkey AS company, year(o_orderdate) AS year, round(sum(o_totalprice), 2) AS revenue, count(*) AS orders FROM orders GROUP BY ALL),
filings AS (
  SELECT company, year, revenue, revenue * 0.18 AS net_income, revenue * 0.25 AS operating_income, revenue * 0.22 AS pretax, revenue * 0.04 AS tax, revenue * 0.03 AS depreciation,
    orders * 1000.0::DOUBLE AS shares, c_acctbal * 20 AS equity, orders * 9000.0::DOUBLE AS liabilities, orders * 4000.0::DOUBLE AS debt, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS cash,
    revenue / 20000.0::DOUBLE AS price, orders * 0.5::DOUBLE AS dividend
  FROM yearly JOIN customer ON company = c_custkey)"""

FUNDAMENTALS = FILINGS + """,
raw AS (
  SELECT *, dense_rank() OVER w AS n, net_income / nullif(shares, 0) AS eps_, lead(revenue) OVER w AS rev0, lead(net_income) OVER w AS net0
  FROM filings WINDOW w AS (PARTITION BY company ORDER BY year DESC)),
per_year AS (
  SELECT company, year, round(eps_, 4) AS eps, round(CASE WHEN eps_ > 0 THEN price / eps_ END, 4) AS pe,
    round(CASE WHEN equity / shares > 0 THEN price / (equity / shares) END, 4) AS pb, round(CASE WHEN revenue / shares > 0 THEN price / (revenue / shares) END, 4) AS ps,
    round(CASE WHEN equity <> 0 THEN net_income / equity END * 100, 4) AS roe, round(CASE WHEN revenue <> 0 THEN net_income / revenue END * 100, 4) AS npm,
    round(CASE WHEN equity <> 0 THEN liabilities / equity END, 4) AS debt_to_equity, round(coalesce(CASE WHEN price > 0 THEN dividend / price END * 100, 0), 4) AS dividend_yield,
    round(CASE WHEN rev0 <> 0 THEN (revenue - rev0) / abs(rev0) * 100 END, 4) AS revenue_growth, round(CASE WHEN net0 <> 0 THEN (net_income - net0) / abs(net0) * 100 END, 4) AS earnings_growth
  FROM raw WHERE n <= 5)"""

RATIOS = ("eps", "pe", "pb", "ps", "roe", "npm", "debt_to_equity", "dividend_yield", "revenue_growth", "earnings_growth")
AVERAGED = FUNDAMENTALS + ", averaged AS (SELECT company, count(*) AS years, " + ", ".join(f"round(avg({r}), 3) AS avg_{r}" for r in RATIOS) + " FROM per_year GROUP BY company)"

PRICES = """
prices AS (
  SELECT p_brand AS ticker, CAST(l_shipdate AS DATE) AS date, max(l_extendedprice / l_quantity) AS high, min(l_extendedprice / l_quantity) AS low, avg(l_extendedprice / l_quantity) AS close, sum(l_quantity) AS volume
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)"""
RECENT = PRICES + ", recent AS (SELECT * FROM (SELECT *, max(date) OVER (PARTITION BY ticker) AS newest FROM prices) WHERE date > newest - INTERVAL 6 MONTH)"
WIN = "win AS (SELECT ticker, round((count(*) FILTER (close > before) + 1) / count(*), 6) AS win FROM (SELECT *, lag(close) OVER (PARTITION BY ticker ORDER BY date) AS before FROM recent) GROUP BY ticker)"


def _swings(source: str) -> str:
    return f"""swings AS (
  SELECT ticker, month, round(max(top / low - 1), 6) AS vup, round(min(1 - high / floor), 6) AS vdown FROM (
    SELECT *, max(high) OVER w AS top, min(low) OVER w AS floor FROM (SELECT *, strftime(date, '%Y-%m') AS month FROM {source})
    WINDOW w AS (PARTITION BY ticker, month ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) GROUP BY ticker, month)"""


def _mat(source: str) -> str:
    return f"""mat AS (
  SELECT ticker, round(avg(close), 4) AS mat, round((avg(close) - max_by(close, date)) / max_by(close, date), 6) AS diff_mat
  FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS n FROM {source}) WHERE n <= 43 GROUP BY ticker)"""


SNAPSHOT = """snap AS (
  SELECT ticker, round(max_by(close, date), 4) AS last_close, round(avg(volume), 4) AS avg_volume, round(max(high), 4) AS high_52w, round(min(low), 4) AS low_52w
  FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY date DESC) AS n FROM prices) WHERE n <= 252 GROUP BY ticker)"""

GEO = "'R' || n_regionkey || lpad(n_nationkey::VARCHAR, 2, '0')"
OBSERVATIONS = f"""
observations AS (
  SELECT dataset, year, geo, slice_key, CASE WHEN m >= 20000 THEN m END AS value FROM (
    SELECT o_orderpriority AS dataset, year(l_shipdate) AS year, {GEO} AS geo, 'flag=' || l_returnflag || '|status=' || l_linestatus AS slice_key, round(avg(l_extendedprice), 4) AS m
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL)),
regions AS (SELECT 'R' || r_regionkey AS code FROM region UNION ALL SELECT {GEO} FROM nation)"""
DESCRIBED = """round(low, 4) AS low, round(high, 4) AS high, round(p02, 4) AS p02, round(p50, 4) AS p50, round(p98, 4) AS p98,
  round(CASE WHEN p50 - p02 > 0 THEN (p98 - p50) / (p50 - p02) END, 4) AS skew, CASE WHEN low < 0 AND high > 0 THEN 'diverging' ELSE 'sequential' END AS kind"""
PERCENTILES = "min(value) AS low, max(value) AS high, quantile_cont(value, 0.02) AS p02, quantile_cont(value, 0.5) AS p50, quantile_cont(value, 0.98) AS p98"
UNIVERSE = """universe AS (
  SELECT level, coalesce(known, seen, 0) AS universe FROM (SELECT unnest([0, 1, 2, 3]) AS level)
  LEFT JOIN (SELECT length(code) - 2 AS level, count(DISTINCT code) AS known FROM regions GROUP BY 1) USING (level)
  LEFT JOIN (SELECT length(geo) - 2 AS level, count(DISTINCT geo) AS seen FROM observations GROUP BY 1) USING (level))"""

EDGES = NOTICES + ", edges AS (SELECT DISTINCT 'c' || authority AS src, 's' || company AS dst FROM notices), both_ways AS (SELECT src, dst FROM edges UNION SELECT dst, src FROM edges)"

LEXICAL = r"""
lexed AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda t: t <> '') AS t FROM documents),
counted AS (SELECT doc_id, len(t) AS n, len(list_filter(t, lambda x: x = 'the')) AS a, len(list_filter(t, lambda x: x = 'of')) AS b, len(list_filter(t, lambda x: x = 'and')) AS c FROM lexed),
lexical AS (SELECT doc_id, score, row_number() OVER (ORDER BY score DESC, doc_id) AS rank FROM (
  SELECT doc_id, round((a + b + c) / n, 8) AS score FROM counted WHERE a > 0 AND b > 0 AND c > 0 ORDER BY score DESC, doc_id LIMIT 100))"""
VECTOR = """
q AS (SELECT embedding::DOUBLE[] AS q FROM embeddings ORDER BY vec_id LIMIT 1),
vectors AS (SELECT vec_id, score, row_number() OVER (ORDER BY score DESC, vec_id) AS rank FROM (
  SELECT vec_id, round(list_dot_product(embedding::DOUBLE[], q) / (sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) * sqrt(list_dot_product(q, q))), 8) AS score
  FROM embeddings, q ORDER BY score DESC, vec_id LIMIT 100))"""

SCORED = NOTICES + """,
s1 AS (SELECT *, total AS chosen, exp(-pow(abs(log10(total) - log10(estimate)) / 0.7, 2)) AS ne, exp(-pow(abs(log10(total) - log10(payable)) / 0.7, 2)) AS np FROM notices),
s2 AS (SELECT *, (ne + np * 0.4) / 1.4 AS consistency, CASE WHEN chosen <= 1e9 THEN 1.0 ELSE greatest(0, 1 - (log10(chosen) - 9) / 2.5) END AS plausibility, abs(log10(total) - log10(payable)) > log10(5) AS apart FROM s1),
scored AS (SELECT *, consistency * plausibility AS confidence, consistency * plausibility < 0.5 AS low,
  CASE WHEN consistency * plausibility >= 0.5 THEN 'ok' WHEN consistency < plausibility THEN 'value_disagreement' ELSE 'implausible_magnitude' END AS flag FROM s2)"""

_Y = "(SELECT DISTINCT o_custkey FROM orders WHERE year(o_orderdate) = {})"
_CHANGE = "strftime({}, '%Y-%m-%d %H:%M:%S')"

ORACLE_SQL = {
    "sector_summary": f"WITH {CONTRACTS} SELECT division, {TRUSTED} FROM contracts GROUP BY division ORDER BY total_value DESC, division LIMIT 20",
    "collapse_modifications": f"WITH {CONTRACTS} SELECT notice_id, contract_key, round(current_value, 4) AS current_value, is_current FROM contracts",
    "contract_projection": f"""WITH {CONTRACTS} SELECT contract_key, count(*) AS notice_count, round(max(current_value) FILTER (is_current), 4) AS current_value,
        round(min_by(total, (pub_date, line, part, company)) FILTER (notice_type <> 'can-modif'), 4) AS award_value, max(pub_date)::VARCHAR AS last_date FROM contracts GROUP BY contract_key""",
    "company_totals": f"WITH {CONTRACTS} SELECT company, {TRUSTED} FROM contracts GROUP BY company",
    "authority_totals": f"WITH {CONTRACTS} SELECT authority, {TRUSTED} FROM contracts GROUP BY authority",
    "contracts_by_country": f"WITH {CONTRACTS} SELECT nation, {TRUSTED} FROM contracts GROUP BY nation",
    "top_companies_per_country": f"WITH {CONTRACTS}, t AS (SELECT nation, company, {TRUSTED} FROM contracts GROUP BY ALL) SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY nation ORDER BY total_value DESC, company) AS place FROM t WHERE total_value > 0) WHERE place <= 5",
    "trade_pairs": f"WITH {CONTRACTS}, t AS (SELECT authority, company, {TRUSTED} FROM contracts GROUP BY ALL) SELECT count(*) AS pairs, round(sum(total_value), 0) AS total_eur, sum(contracts)::BIGINT AS total_contracts FROM t",
    "single_bidder_by_country": f"WITH {CONTRACTS} SELECT nation, count(*) FILTER (bidders = 1) AS single, count(*) AS total, round(count(*) FILTER (bidders = 1) / count(*), 6) AS rate FROM contracts WHERE is_current AND bidders IS NOT NULL GROUP BY nation HAVING count(*) >= 20",
    "bidder_breakdown": f"WITH {NOTICES} SELECT coalesce(bidders::VARCHAR, 'Not disclosed') AS bidders, count(*) AS n FROM notices GROUP BY 1",
    "value_confidence": f"""WITH {SCORED} SELECT notice_id, count(*) AS n, round(max(chosen), 4) AS chosen_value, round(max(consistency), 6) AS consistency, round(max(plausibility), 6) AS plausibility,
        round(max(confidence), 6) AS confidence, max(flag) AS flag, bool_or(low) AS low_confidence, bool_or(apart) AS payable_discrepancy FROM scored GROUP BY notice_id""",
    "value_quality_overview": f"WITH {SCORED} SELECT flag, count(*) AS n, count(*) FILTER (low) AS low, round(sum(chosen), 0) AS value FROM scored GROUP BY flag",
    "scale_normalise": f"""WITH {NOTICES}, r AS (SELECT *, round(total, 2) AS t FROM notices),
        m AS (SELECT *, t / estimate BETWEEN 900 AND 1100 AND (country = 'PRT' OR (abs(t - round_even(t, 0)) < 1e-6 AND round_even(t, 0) % 10 = 0 AND round_even(t, 0) % 1000 <> 0)) AS leak FROM r)
        SELECT country, CASE WHEN leak THEN 'ratio' END AS scale_tier, count(*) AS n, round(sum(CASE WHEN leak THEN t / 1000 ELSE t END), 0) AS total, round(sum(estimate), 0) AS estimate, round(sum(payable), 0) AS payable FROM m GROUP BY ALL""",
    "red_flags": f"""WITH {NOTICES}, f AS (SELECT coalesce(bidders = 1, false) AS single_bidder, line > 4 AS non_open, line = 7 AS no_call, part % 3 = 0 AS price_only FROM notices)
        SELECT single_bidder::INT + non_open::INT + no_call::INT + price_only::INT AS flags, count(*) AS n, count(*) FILTER (single_bidder) AS single_bidder, count(*) FILTER (non_open) AS non_open, count(*) FILTER (no_call) AS no_call, count(*) FILTER (price_only) AS price_only FROM f GROUP BY 1""",
    "null_profile": f"WITH {NOTICES} " + " UNION ALL ".join(f"SELECT count(*) AS rows, '{f}' AS field, count(*) FILTER ({f} IS NULL) AS missing FROM notices" for f in ("bidders", "total", "division", "pub_date")),
    "currency_quality": "WITH c AS (SELECT upper(regexp_extract(o_orderpriority, '-([A-Z]{3})', 1)) AS code, o_orderstatus FROM orders) SELECT code, count(*) AS n, count(*) FILTER (o_orderstatus = 'F') AS converted, count(*) FILTER (regexp_full_match(code, '[A-Z]{3}')) AS well_formed FROM c GROUP BY code",
    "contracts_timeline": f"WITH {NOTICES} SELECT pub_date::VARCHAR AS day, count(*) AS n FROM notices GROUP BY 1",
    "value_timeline": f"WITH {CONTRACTS} SELECT pub_date::VARCHAR AS pub_date, {TRUSTED} FROM contracts WHERE current_value IS NOT NULL GROUP BY 1",
    "outlier_months": f"WITH {NOTICES}, m AS (SELECT strftime(pub_date, '%Y-%m') AS month, avg(total) AS mean, count(*) AS n FROM notices GROUP BY 1 HAVING count(*) >= 30) SELECT month, n, round(mean, 4) AS mean FROM m WHERE mean > 1.5 * (SELECT quantile_cont(mean, 0.5) FROM m)",
    "link_modifications": f"WITH {NOTICES}, a AS (SELECT contract_key, min_by(notice_id, (pub_date, line, part, company)) AS award FROM notices WHERE notice_type <> 'can-modif' GROUP BY 1) SELECT contract_key, notice_id AS modification, award FROM notices JOIN a USING (contract_key) WHERE notice_type = 'can-modif'",
    "modifications_without_award": f"WITH {NOTICES} SELECT contract_key, count(*) AS n FROM notices GROUP BY 1 HAVING count(*) FILTER (notice_type <> 'can-modif') = 0",
    "procurement_only": "SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '2001-10-01')",
    "cross_source_overlap": f"SELECT count(*) AS customers FROM {_Y.format(1997)} WHERE o_custkey IN {_Y.format(1998)}",
    "set_difference": f"SELECT o_custkey FROM {_Y.format(1997)} WHERE o_custkey NOT IN {_Y.format(1998)}",
    "symmetric_diff": f"SELECT o_custkey, 'missing' AS side FROM {_Y.format(1997)} WHERE o_custkey NOT IN {_Y.format(1998)} UNION ALL SELECT o_custkey, 'extra' FROM {_Y.format(1998)} WHERE o_custkey NOT IN {_Y.format(1997)}",
    "dedup_pairs": "WITH c AS (SELECT *, floor(c_acctbal / 100)::BIGINT AS band FROM customer), m AS (SELECT c_mktsegment, c_nationkey, band, min(c_custkey) AS kept FROM c GROUP BY ALL) SELECT kept, c_custkey AS dropped, c_mktsegment, c_nationkey, band FROM c JOIN m USING (c_mktsegment, c_nationkey, band) WHERE kept < c_custkey",
    "fundamentals_per_year": f"WITH {FUNDAMENTALS} SELECT * FROM per_year",
    "fundamentals_avg": f"WITH {AVERAGED} SELECT * FROM averaged",
    "long_screen": f"""WITH {AVERAGED}, f AS (SELECT company, coalesce(avg_pe <= 15, false) AS pe_ok, coalesce(avg_pb <= 1.5, false) AS pb_ok, coalesce(avg_roe >= 15, false) AS roe_ok,
        coalesce(avg_npm >= 15, false) AS npm_ok, coalesce(avg_debt_to_equity <= 1.5, false) AS debt_to_equity_ok, coalesce(avg_dividend_yield >= 3.5, false) AS dividend_yield_ok FROM averaged)
        SELECT *, pe_ok AND pb_ok AND roe_ok AND npm_ok AND debt_to_equity_ok AND dividend_yield_ok AS passes_all FROM f""",
    "valuation": f"""WITH {FILINGS}, f AS (SELECT *, operating_income + depreciation AS ebitda, debt - coalesce(cash, 0) AS net_debt, operating_income * (1 - greatest(0, least(0.5, coalesce(tax / nullif(pretax, 0), 0.21)))) AS nopat
          FROM filings QUALIFY row_number() OVER (PARTITION BY company ORDER BY year DESC) = 1), g AS (SELECT *, price * shares + net_debt AS ev FROM f)
        SELECT company, year, round(ebitda, 4) AS ebitda, round(ebitda / nullif(revenue, 0) * 100, 4) AS ebitda_margin, round(net_debt, 4) AS net_debt, round(nopat, 4) AS nopat, round(nopat / nullif(equity + net_debt, 0) * 100, 4) AS roic, round(ev, 4) AS ev,
          round(nullif(ev, 0) / nullif(ebitda, 0), 4) AS ev_ebitda, round(nullif(ev, 0) / nullif(revenue, 0), 4) AS ev_revenue, round(nullif(ev, 0) / nullif(operating_income, 0), 4) AS ev_ebit FROM g""",
    "win_probability": f"WITH {RECENT}, {WIN} SELECT * FROM win",
    "vup_vdown_monthly": f"WITH {PRICES}, {_swings('prices')} SELECT * FROM swings",
    "mat_43": f"WITH {PRICES}, {_mat('prices')} SELECT * FROM mat",
    "market_snapshot": f"WITH {PRICES}, {SNAPSHOT} SELECT * FROM snap",
    "short_screen": f"""WITH {RECENT}, {WIN}, {_swings('recent')}, {_mat('recent')}, {SNAPSHOT}, a AS (SELECT ticker, round(avg(vup), 6) AS avg_vup, round(avg(vdown), 6) AS avg_vdown FROM swings GROUP BY 1),
        k AS (SELECT ticker FROM recent GROUP BY 1 HAVING count(*) >= 5),
        j AS (SELECT p.ticker, last_close, avg_volume, mat, diff_mat, coalesce(win, 0) AS win, coalesce(avg_vup, 0) AS avg_vup, coalesce(avg_vdown, 0) AS avg_vdown FROM (SELECT DISTINCT p_brand AS ticker FROM part) p
          LEFT JOIN snap USING (ticker) LEFT JOIN (SELECT * FROM win SEMI JOIN k USING (ticker)) w USING (ticker) LEFT JOIN (SELECT * FROM a SEMI JOIN k USING (ticker)) b USING (ticker) LEFT JOIN (SELECT * FROM mat SEMI JOIN k USING (ticker)) m USING (ticker)),
        f AS (SELECT *, coalesce(mat IS NOT NULL AND avg_volume > 50, false) AS volume_ok, coalesce(mat IS NOT NULL AND last_close BETWEEN 900 AND 1600, false) AS price_ok, coalesce(mat IS NOT NULL AND win > 0.5, false) AS win_ok,
          coalesce(mat IS NOT NULL AND avg_vup > 0.3 AND avg_vdown < -0.3, false) AS swing_ok, coalesce(mat IS NOT NULL AND diff_mat > -0.025, false) AS mat_ok FROM j)
        SELECT ticker, last_close, avg_volume, win, avg_vup, avg_vdown, diff_mat, volume_ok, price_ok, win_ok, swing_ok, mat_ok, volume_ok AND price_ok AND win_ok AND swing_ok AND mat_ok AS passes FROM f""",
    "annual_avg_price": f"WITH {PRICES} SELECT ticker, year(date) AS year, round(avg(close), 4) AS price FROM prices GROUP BY ALL",
    "slice_stats": f"WITH {OBSERVATIONS}, s AS (SELECT dataset, slice_key, count(*) AS n, {PERCENTILES} FROM observations WHERE value IS NOT NULL GROUP BY ALL) SELECT dataset, slice_key, n, {DESCRIBED} FROM s",
    "dataset_stats": f"WITH {OBSERVATIONS}, s AS (SELECT dataset, min(year) AS y0, max(year) AS y1, count(*) AS n, {PERCENTILES} FROM observations GROUP BY dataset) SELECT dataset, y0, y1, n, {DESCRIBED} FROM s",
    "level_universe": f"WITH {OBSERVATIONS}, {UNIVERSE} SELECT level, universe FROM universe",
    "year_availability": f"WITH {OBSERVATIONS}, {UNIVERSE}, a AS (SELECT dataset, length(geo) - 2 AS level, slice_key, year, count(DISTINCT geo) FILTER (value IS NOT NULL) AS present FROM observations GROUP BY ALL) SELECT dataset, level, slice_key, year, present, round(CASE WHEN present > 0 AND universe > 0 THEN present * 100.0::DOUBLE / universe END, 4) AS pct FROM a LEFT JOIN universe USING (level)",
    "series": f"WITH {OBSERVATIONS} SELECT geo, year, slice_key, round(value, 4) AS value FROM observations WHERE dataset = '1-URGENT' AND length(geo) = 4 AND year BETWEEN 1996 AND 1999 AND slice_key LIKE '%status=F'",
    "bivariate": f"WITH {OBSERVATIONS}, o AS (SELECT * FROM observations WHERE year = 1998 AND slice_key = 'flag=A|status=F') SELECT geo, round(a.value, 4) AS x, round(b.value, 4) AS y FROM o a JOIN o b USING (geo) WHERE a.dataset = '1-URGENT' AND b.dataset = '5-LOW' ORDER BY x DESC NULLS LAST, geo LIMIT 20",
    "latest_run_per_key": "SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1",
    "stale_keys": """WITH u AS (SELECT user_id, max(ts) FILTER (event_type = 'signup') AS last FROM events GROUP BY 1), a AS (SELECT user_id, last, floor((epoch_us((SELECT max(ts) FROM events)) - epoch_us(last)) / 3600000000)::BIGINT AS hours FROM u)
        SELECT user_id, hours, CASE WHEN last IS NULL THEN 'never' WHEN hours > 48 THEN 'stale' ELSE 'fresh' END AS state FROM a""",
    "producer_metrics": "SELECT event_type, count(*) AS total, count(*) FILTER (ts > (SELECT max(ts) FROM events) - INTERVAL 7 DAY) AS last_7d, " + _CHANGE.format("max(ts)") + " AS newest FROM events GROUP BY 1",
    "events_per_day": "SELECT event_type, ts::DATE::VARCHAR AS day, count(*) AS n, round(sum(value), 2) AS value FROM events GROUP BY ALL",
    "failing_since": "WITH p AS (SELECT *, max(ts) FILTER (event_type = 'purchase') OVER (PARTITION BY user_id) AS passed FROM events) SELECT user_id, " + _CHANGE.format("max(passed)") + " AS last_pass, " + _CHANGE.format("min(ts) FILTER (event_type = 'error' AND (passed IS NULL OR ts > passed))") + " AS failing_since FROM p GROUP BY 1",
    "nuts_rollup": f"""WITH r AS (SELECT 'R' || r_regionkey AS code FROM region UNION ALL SELECT {GEO} FROM nation), p AS (SELECT s_suppkey, s_acctbal, unnest([{GEO}, 'R' || n_regionkey]) AS code FROM supplier JOIN nation ON s_nationkey = n_nationkey)
        SELECT code, count(DISTINCT s_suppkey) AS companies, coalesce(round(sum(s_acctbal), 2), 0) AS balance FROM r LEFT JOIN p USING (code) GROUP BY code""",
    "entity_by_region": f"WITH {CONTRACTS}, t AS (SELECT nation, {TRUSTED} FROM contracts GROUP BY nation) SELECT r_name, round(sum(total_value), 0) AS value, sum(contracts)::BIGINT AS contracts FROM t JOIN nation ON nation = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY r_name",
    "khop": f"""WITH {EDGES}, seeds AS (SELECT DISTINCT dst AS seed FROM edges), h1 AS (SELECT DISTINCT seed, e.dst AS node FROM seeds JOIN both_ways e ON seed = e.src),
        h2 AS (SELECT DISTINCT seed, e.dst AS node FROM h1 JOIN both_ways e ON h1.node = e.src), a AS (SELECT seed, seed AS node, 0 AS hops FROM seeds UNION ALL SELECT seed, node, 1 FROM h1 UNION ALL SELECT seed, node, 2 FROM h2),
        m AS (SELECT seed, node, min(hops) AS hops FROM a GROUP BY ALL) SELECT seed, hops, count(*) AS nodes FROM m GROUP BY ALL""",
    "shortest_path": f"""WITH {EDGES}, pairs AS (SELECT 's' || s_suppkey AS src, 's' || (s_suppkey + 1) AS dst FROM supplier), h0 AS (SELECT DISTINCT src AS seed, src AS node FROM pairs),
        h1 AS (SELECT DISTINCT seed, dst AS node FROM h0 JOIN both_ways ON node = src), h2 AS (SELECT DISTINCT seed, dst AS node FROM h1 JOIN both_ways ON node = src),
        h3 AS (SELECT DISTINCT seed, dst AS node FROM h2 JOIN both_ways ON node = src), h4 AS (SELECT DISTINCT seed, dst AS node FROM h3 JOIN both_ways ON node = src),
        a AS (SELECT *, 0 AS hops FROM h0 UNION ALL SELECT *, 1 FROM h1 UNION ALL SELECT *, 2 FROM h2 UNION ALL SELECT *, 3 FROM h3 UNION ALL SELECT *, 4 FROM h4)
        SELECT src, dst, min(hops) AS hops FROM pairs JOIN a ON src = seed AND dst = node GROUP BY ALL""",
    "group_closure": """WITH RECURSIVE up AS (SELECT c_custkey AS node, c_custkey AS ancestor, 0 AS hops FROM customer UNION ALL SELECT node, ancestor // 2, hops + 1 FROM up WHERE ancestor > 0 AND hops < 5) SELECT ancestor, hops, count(*) AS members FROM up GROUP BY ALL""",
    "degree_distribution": f"""WITH {EDGES}, ends AS (SELECT src AS node FROM edges UNION ALL SELECT dst FROM edges), nodes AS (SELECT 'customer' AS kind, 'c' || c_custkey AS node FROM customer UNION ALL SELECT 'supplier', 's' || s_suppkey FROM supplier),
        d AS (SELECT kind, coalesce(n, 0) AS degree FROM nodes LEFT JOIN (SELECT node, count(*) AS n FROM ends GROUP BY 1) USING (node))
        SELECT kind, count(*) AS nodes, count(*) FILTER (degree = 0) AS isolated, min(degree) AS least, max(degree) AS most, round(avg(degree), 4) AS mean, round(quantile_cont(degree, 0.5), 4) AS p50, round(quantile_cont(degree, 0.95), 4) AS p95,
          count(*) FILTER (degree BETWEEN 1 AND 9) AS d1_9, count(*) FILTER (degree BETWEEN 10 AND 49) AS d10_49, count(*) FILTER (degree >= 50) AS d50 FROM d GROUP BY kind""",
    "best_replacement": "SELECT p_type, p_partkey, p_size FROM part QUALIFY row_number() OVER (PARTITION BY p_type ORDER BY p_size < 25, p_retailprice DESC, p_partkey) = 1",
    "lexical_search": f"WITH {LEXICAL} SELECT doc_id, score, rank FROM lexical",
    "vector_knn": f"WITH {VECTOR} SELECT vec_id, score, rank FROM vectors",
    "hybrid_rrf": f"WITH {LEXICAL}, {VECTOR} SELECT coalesce(doc_id, vec_id) AS doc_id, l.rank AS ra, v.rank AS rb, round(coalesce(1.0::DOUBLE / (60 + l.rank), 0) + coalesce(1.0::DOUBLE / (60 + v.rank), 0), 8) AS score FROM lexical l FULL JOIN vectors v ON doc_id = vec_id ORDER BY score DESC, 1 LIMIT 20",
    "unified_search": "WITH n AS (SELECT 1 AS kind, s_suppkey AS key, s_name AS name FROM supplier UNION ALL SELECT 2, c_custkey, c_name FROM customer UNION ALL SELECT 3, p_partkey, p_name FROM part) SELECT kind, key, name, CASE WHEN lower(name) = 'er#00000001' THEN 4 WHEN starts_with(lower(name), 'er#00000001') THEN 2 ELSE 0 END AS tier FROM n WHERE contains(lower(name), 'er#00000001') ORDER BY kind, tier DESC, length(name), name, key LIMIT 50",
    "assertions_report": """WITH m AS (
        SELECT 'orders_unique' AS assertion, 'block' AS severity, count(*) FILTER (n > 1) AS value, sum(n) AS total, count(*) FILTER (n > 1) = 0 AS ok FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey)
        UNION ALL SELECT 'lines_unique', 'warn', count(*) FILTER (n > 1), sum(n), count(*) FILTER (n > 1) = 0 FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)
        UNION ALL SELECT 'lines_have_orders', 'block', count(*) FILTER (l_orderkey NOT IN (SELECT o_orderkey FROM orders)), count(*), count(*) FILTER (l_orderkey NOT IN (SELECT o_orderkey FROM orders)) = 0 FROM lineitem
        UNION ALL SELECT 'orders_have_customers', 'block', count(*) FILTER (o_custkey NOT IN (SELECT c_custkey FROM customer)), count(*), count(*) FILTER (o_custkey NOT IN (SELECT c_custkey FROM customer)) = 0 FROM orders
        UNION ALL SELECT 'balances_positive', 'warn', count(*) FILTER (c_acctbal < 0), count(*), count(*) FILTER (c_acctbal < 0) <= 10 FROM customer
        UNION ALL SELECT 'discount_band', 'block', count(*) FILTER (l_discount > 0.05), count(*), count(*) < 100 OR count(*) FILTER (l_discount > 0.05) / count(*) BETWEEN 0.2 AND 0.7 FROM lineitem
        UNION ALL SELECT 'supplier_names', 'block', count(*) FILTER (trim(s_name) <> ''), count(*), count(*) FILTER (trim(s_name) <> '') / count(*) >= 0.99 FROM supplier
        UNION ALL SELECT 'error_events', 'warn', count(*) FILTER (event_type = 'error'), count(*), count(*) FILTER (event_type = 'error') >= 100 FROM events)
        SELECT assertion, severity, value::BIGINT AS value, total::BIGINT AS total, CASE WHEN ok THEN 'pass' WHEN severity = 'block' THEN 'fail' ELSE 'warn' END AS status FROM m""",
    "event_classify": """WITH e AS (SELECT event_type, json_extract_string(props, '$.k')::INT AS k FROM events), a AS (SELECT CASE WHEN event_type = 'error' THEN CASE WHEN k % 2 = 0 THEN 'DELETED' WHEN k % 3 = 0 THEN 'DIRTY' ELSE 'IGNORE' END
        WHEN event_type = 'view' THEN 'IGNORE' WHEN event_type = 'purchase' AND k % 5 IN (2, 3) THEN 'IGNORE' ELSE 'DIRTY' END AS action FROM e) SELECT action, count(*) AS n FROM a GROUP BY 1""",
    "period_parse": """WITH p AS (SELECT o_orderdate AS d, year(o_orderdate)::VARCHAR AS y, o_orderkey % 6 AS k FROM orders), q AS (SELECT CASE k WHEN 0 THEN y WHEN 1 THEN strftime(d, '%Y-%m') WHEN 2 THEN y || 'M' || strftime(d, '%m') WHEN 3 THEN y || '-Q' || quarter(d) WHEN 4 THEN y || 'S' || (CASE WHEN month(d) <= 6 THEN 1 ELSE 2 END) ELSE 'x' || y END AS period,
        CASE k WHEN 0 THEN date_trunc('year', d) WHEN 1 THEN date_trunc('month', d) WHEN 2 THEN date_trunc('month', d) WHEN 3 THEN date_trunc('quarter', d) WHEN 4 THEN make_date(year(d), CASE WHEN month(d) <= 6 THEN 1 ELSE 7 END, 1) END AS start FROM p)
        SELECT period, count(*) AS n, start::DATE::VARCHAR AS start FROM q GROUP BY period, start""",
    "adhoc_sql_guard": "SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 0) AS value FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice > 1000 GROUP BY o_orderstatus",
    "events_windowed": "SELECT strftime(time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01'), '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n FROM events GROUP BY ALL",
}
_FOLD = "SELECT user_id AS entity, " + _CHANGE.format("min(ts)") + " AS first_seen, " + _CHANGE.format("max(ts)") + " AS last_changed, count(*) AS edit_count, max_by(event_type = 'error', (ts, event_id)) AS is_deleted FROM events GROUP BY user_id"
ORACLE_SQL["dirty_set_fold"] = ORACLE_SQL["dirty_set_stream"] = _FOLD

ORACLE_SQL |= {
    "field_completeness": f"WITH {NOTICES}, n AS (SELECT n.*, o_orderpriority AS priority FROM notices n JOIN orders ON contract_key = o_orderkey) SELECT priority, count(*) AS n, round(count(bidders) / greatest(count(*), 1) * 100, 1) AS bidders, round(count(total) / greatest(count(*), 1) * 100, 1) AS total, round(count(division) / greatest(count(*), 1) * 100, 1) AS division FROM n GROUP BY priority",
    "code_formats": "SELECT count(*) FILTER (length(p_type) <= 5) AS short, count(*) FILTER (length(p_type) BETWEEN 6 AND 7) AS middle, count(*) FILTER (length(p_type) > 7) AS long, count(*) FILTER (p_type IS NULL) AS missing FROM part",
    "price_freshness": f"WITH {PRICES}, a AS (SELECT ticker, datediff('day', max(date), (SELECT max(date) FROM prices)) AS age FROM prices GROUP BY ticker) SELECT count(*) AS tickers, count(*) FILTER (age <= 7) AS fresh, count(*) FILTER (age BETWEEN 8 AND 30) AS ageing, count(*) FILTER (age > 30) AS stale FROM a",
    "common_status": "WITH n AS (SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL) SELECT o_custkey, o_orderstatus AS status FROM n QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderstatus) = 1",
    "spend_buckets": "SELECT CASE WHEN o_totalprice < 50000 THEN 'under 50k' WHEN o_totalprice < 200000 THEN '50k to 200k' ELSE '200k and more' END AS bucket, strftime(o_orderdate, '%Y-%m-01') AS month, count(*) AS n FROM orders GROUP BY ALL",
    "coverage_panel": f"WITH {NOTICES} SELECT count(DISTINCT company) AS companies, count(DISTINCT authority) AS authorities, count(DISTINCT contract_key) AS contracts, min(pub_date)::VARCHAR AS first_day, max(pub_date)::VARCHAR AS last_day FROM notices",
    "top_division_per_nation": f"WITH {NOTICES}, n AS (SELECT nation, division, count(*) AS n FROM notices GROUP BY ALL) SELECT nation, division, n FROM n QUALIFY row_number() OVER (PARTITION BY nation ORDER BY n DESC, division) = 1",
    "upsert_latest": "SELECT user_id, max_by(event_type, (ts, event_id)) AS event_type, max_by(value, (ts, event_id)) FILTER (value <= 50) AS value, max(event_id) AS seq FROM events GROUP BY user_id",
    "status_facets": 'SELECT o_orderstatus, count(*) AS "all", count(*) FILTER (o_totalprice > 250000) AS matching FROM orders GROUP BY 1',
    "sibling_filings": f"WITH {FILINGS} SELECT a.company, count(*) AS years, min(a.year) AS first_year FROM filings a JOIN filings b ON a.company = b.company - 1 AND a.year = b.year GROUP BY a.company",
}


def _half_up(sql: str) -> str:
    """round(x, n) written as plain arithmetic, half up."""
    out, at = "", 0
    while (start := sql.find("round(", at)) >= 0:
        if start and (sql[start - 1].isalnum() or sql[start - 1] == "_"):
            out, at = out + sql[at : start + 6], start + 6
            continue
        depth, end, comma = 1, start + 6, -1
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            comma = end if sql[end] == "," and depth == 1 else comma
            end += 1
        inner, digits = _half_up(sql[start + 6 : comma]), sql[comma + 1 : end - 1].strip()
        out, at = out + sql[at:start] + f"(floor(({inner}) * 1e{digits} + 0.5) / 1e{digits})", end
    return out + sql[at:]


ORACLE_SQL = {name: _half_up(sql) for name, sql in ORACLE_SQL.items()}
