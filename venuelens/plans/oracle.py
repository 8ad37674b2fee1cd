"""SQL for every registered query, written against the driver tables alone.

Each statement starts from the same tables as the Spark query and shares only the
definition of the fact; it is run by another engine to check the results.
"""

from __future__ import annotations

FACT = """
served AS (
  SELECT DISTINCT l_orderkey, p_brand, l_returnflag
  FROM lineitem JOIN part ON l_partkey = p_partkey
),
listed AS (
  SELECT l_orderkey, string_agg(p_brand, ' , ' ORDER BY p_brand, l_returnflag) AS cuisines,
         count(*) AS cuisine_count
  FROM served GROUP BY l_orderkey
),
lines AS (
  SELECT l_orderkey, sum(CAST(l_quantity AS BIGINT)) AS votes,
         sum(CAST(round(l_discount * 100) AS BIGINT)) AS points, count(*) AS n,
         bool_or(l_returnflag = 'R') AS any_r, bool_or(l_returnflag = 'A') AS any_a
  FROM lineitem GROUP BY l_orderkey
),
base AS (
  SELECT o_orderkey AS venue_id, c_name AS venue_name, n_regionkey AS country_code,
         coalesce(r_name, 'Unknown') AS country, n_name AS city, c_mktsegment AS locality,
         concat_ws(', ', c_mktsegment, n_name, r_name) AS address,
         CAST(c_custkey % 400 - 200 AS DOUBLE) AS longitude, c_acctbal / 100 AS latitude,
         coalesce(listed.cuisines, 'Unspecified') AS cuisines,
         CAST(coalesce(listed.cuisine_count, 1) AS INTEGER) AS cuisine_count,
         r_name AS currency,
         CASE WHEN o_orderstatus <> 'P' AND o_totalprice > 0 THEN o_totalprice END AS cost,
         CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS price_range,
         o_orderpriority AS price_label,
         coalesce(any_a, false) AS has_booking, o_orderstatus = 'O' AS has_delivery,
         CASE o_orderstatus WHEN 'P' THEN true WHEN 'F' THEN false END AS delivering_now,
         CASE WHEN any_r AND points > 0 THEN points / (2.0::DOUBLE * lines.n) END AS rating,
         CAST(coalesce(votes, 0) AS BIGINT) AS votes
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN lines ON lines.l_orderkey = o_orderkey
  LEFT JOIN listed ON listed.l_orderkey = o_orderkey
),
fact AS (
  SELECT venue_id, venue_name, country_code, country, city, locality, address, longitude, latitude,
         latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180
           AND NOT (latitude = 0 AND longitude = 0) AS geo_valid,
         cuisines, cuisine_count, currency, cost,
         CASE WHEN currency IS DISTINCT FROM 'ASIA' OR cost IS NULL THEN NULL
              WHEN cost < 50000 THEN '< 50k' WHEN cost < 100000 THEN '50k-100k'
              WHEN cost < 200000 THEN '100k-200k' WHEN cost < 400000 THEN '200k-400k'
              ELSE '400k+' END AS cost_band,
         price_range, price_label, has_booking, has_delivery, delivering_now, rating,
         rating IS NOT NULL AS is_rated, rating IS NOT NULL AND votes >= 50 AS credible,
         CASE WHEN rating IS NULL THEN 'Not rated' ELSE 'Scored' END AS rating_text,
         votes, votes > 0 AS has_votes,
         CASE WHEN currency = 'ASIA' THEN rating / (cost / 100) END AS value_score
  FROM base
),
home AS (SELECT * FROM fact WHERE country = 'ASIA'),
pairs AS (
  SELECT DISTINCT l_orderkey AS venue_id, p_brand AS cuisine FROM served
  WHERE l_orderkey IN (SELECT venue_id FROM fact)
  UNION ALL
  SELECT venue_id, 'Unspecified' FROM fact WHERE cuisines = 'Unspecified'
),
home_pairs AS (SELECT p.* FROM pairs p JOIN home USING (venue_id)),
combined AS (
  SELECT * FROM home
  WHERE city IN ('NATION_2', 'NATION_7') AND price_range IN (1, 2, 3) AND rating >= 2.0
    AND venue_id IN (SELECT venue_id FROM pairs WHERE cuisine IN ('Brand#3', 'Brand#11'))
)
"""

BOARD = "venue_id, venue_name, city, locality, cuisines, round(cost, 4) AS cost, round(rating, 6) AS rating, votes"
PLACE = "venue_id, city, locality, price_range, round(rating, 6) AS rating, votes"
CREDIBLE = "credible AND cost IS NOT NULL AND rating IS NOT NULL"


def kpi_strip(source: str, exact: bool = False) -> str:
    money, other = (15, 15) if exact else (4, 6)
    return f"""
SELECT count(*) AS restaurants, count(DISTINCT city) AS cities, count(DISTINCT locality) AS localities,
       round(avg(cost), {money}) AS avg_cost, round(quantile_cont(cost, 0.5), {money}) AS median_cost,
       round(quantile_cont(cost, 0.9), {money}) AS p90_cost, round(max(cost), {money}) AS max_cost,
       round(avg(rating), {other}) AS avg_rating, count(rating) AS rated_n,
       count(*) - count(rating) AS not_rated_n,
       round(100.0 * (count(*) - count(rating)) / nullif(count(*), 0), {other}) AS not_rated_pct,
       round(100 * avg(CAST(has_delivery AS INTEGER)), {other}) AS delivery_pct,
       round(100 * avg(CAST(has_booking AS INTEGER)), {other}) AS booking_pct,
       CAST(coalesce(sum(votes), 0) AS BIGINT) AS total_votes, round(avg(votes), {other}) AS avg_votes,
       (SELECT count(DISTINCT cuisine) FROM pairs JOIN {source} USING (venue_id)) AS cuisines,
       round(avg(cuisine_count), {other}) AS avg_cuisines,
       count(*) FILTER (credible) AS credible_n,
       (SELECT venue_name FROM {source} WHERE credible
        ORDER BY rating DESC, votes DESC, venue_id LIMIT 1) AS top_name,
       (SELECT round(rating, {other}) FROM {source} WHERE credible
        ORDER BY rating DESC, votes DESC, venue_id LIMIT 1) AS top_rating,
       (SELECT venue_name FROM {source} WHERE cost IS NOT NULL
        ORDER BY cost DESC, venue_id LIMIT 1) AS priciest_name
FROM {source}"""


PLACE_MEASURES = """count(*) AS restaurants, round(avg(cost), 4) AS avg_cost,
       round(avg(rating), 6) AS avg_rating,
       round(100 * avg(CAST(has_delivery AS INTEGER)), 6) AS delivery_pct"""

CUISINE_TABLE = """
SELECT cuisine, count(*) AS restaurants, avg(rating) AS avg_rating, avg(cost) AS avg_cost,
       CAST(sum(votes) AS BIGINT) AS total_votes, 100 * avg(CAST(has_delivery AS INTEGER)) AS delivery_pct
FROM pairs JOIN {source} USING (venue_id) GROUP BY cuisine"""


def banded(column: str, edges: list[float], labels: list[str], position: bool = False) -> str:
    results = range(1, len(labels) + 1) if position else [f"'{name}'" for name in labels]
    low, *rest = edges
    arms = [f"WHEN {column} < {low} THEN NULL"]
    for i, result in enumerate(results):
        if i < len(rest):
            arms.append(f"WHEN {column} < {rest[i]} THEN {result}")
        else:
            arms.append(f"WHEN {column} IS NOT NULL THEN {result}")
    return f"CASE {' '.join(arms)} END"


RATING_LABELS = ["1.0-1.5", "1.5-2.0", "2.0-2.5", "2.5-3.0", "3.0-3.5", "3.5-4.0", "4.0-4.5", "4.5-5.0"]
RATING_EDGES = [1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 4.5, 5.01]
TREND_LABELS = ["<50k", "50k-100k", "100k-150k", "150k-200k", "200k-250k", "250k-300k", "300k-400k", "400k+"]
TREND_EDGES = [0, 50000, 100000, 150000, 200000, 250000, 300000, 400000]


def values(labels: list[str]) -> str:
    return ", ".join(f"({i}, '{name}')" for i, name in enumerate(labels, 1))


def localities(source: str = "home", floor: int = 120, where: str = "true", name: str = "loc") -> str:
    return f"""{name} AS (
  SELECT city, locality, count(*) AS restaurants, avg(rating) AS avg_rating, avg(cost) AS avg_cost,
         CAST(sum(votes) AS BIGINT) AS total_votes, sum(votes) / count(*)::DOUBLE AS votes_per_venue
  FROM {source} WHERE {where} GROUP BY city, locality HAVING count(*) >= {floor}
)"""


def scored(keep_unrated: bool = False) -> str:
    kept = "true" if keep_unrated else "avg_rating IS NOT NULL"
    return f"""baseline AS (
  SELECT avg(ln(1 + votes_per_venue)) AS dm, stddev_pop(ln(1 + votes_per_venue)) AS ds,
         avg(avg_rating) AS qm, stddev_pop(avg_rating) AS qs, count(*) AS n FROM loc WHERE {kept}
),
scored AS (
  SELECT loc.*,
    CASE WHEN n >= 3 THEN (ln(1 + votes_per_venue) - dm) / CASE WHEN ds > 0 THEN ds ELSE 1 END END AS demand_z,
    CASE WHEN n >= 3 THEN (avg_rating - qm) / CASE WHEN qs > 0 THEN qs ELSE 1 END END AS quality_z
  FROM loc, baseline WHERE {kept}
),
ranked AS (SELECT *, demand_z - quality_z AS score,
           row_number() OVER (ORDER BY round(demand_z - quality_z, 9) DESC NULLS LAST, city, locality) AS place
           FROM scored)"""


SCORES = """city, locality, restaurants, round(avg_rating, 6) AS avg_rating, round(avg_cost, 4) AS avg_cost,
       total_votes, round(votes_per_venue, 6) AS votes_per_venue, round(demand_z, 6) AS demand_z,
       round(quality_z, 6) AS quality_z, round(score, 6) AS score"""


def opportunity(tail: str, keep_unrated: bool = False, **scope) -> str:
    return f"WITH {FACT}, {localities(**scope)}, {scored(keep_unrated)} {tail}"


def on_fact(tail: str) -> str:
    return f"WITH {FACT} {tail}"


def quality_log(loaded: str = "count(*)", columns: int = 19, unnamed: str = "country = 'Unknown'") -> str:
    return on_fact(f"""
SELECT step, CAST(rows_affected AS BIGINT) AS rows_affected, detail FROM (
  SELECT 'load' AS step, {loaded} AS rows_affected, 'rows read, {columns} columns' AS detail FROM fact
  UNION ALL SELECT 'dedupe', {loaded} - count(*), 'repeated venue ids dropped' FROM fact
  UNION ALL SELECT 'country_map', count(*), 'country codes without a name, set to Unknown'
    FROM fact WHERE {unnamed} HAVING count(*) > 0
  UNION ALL SELECT 'drop_constant', count(*), 'switch_to_order_menu never varies, dropped' FROM fact
  UNION ALL SELECT 'rating_zero_to_null', count(*) FILTER (rating IS NULL), 'rating 0 means not rated' FROM fact
  UNION ALL SELECT 'cost_zero_to_null', count(*) FILTER (cost IS NULL), 'cost of 0 or less means unknown' FROM fact
  UNION ALL SELECT 'cuisine_missing', count(*) FILTER (cuisines = 'Unspecified'),
                   'no cuisines, set to Unspecified' FROM fact
  UNION ALL SELECT 'cuisine_explode', count(*), 'venue-cuisine pairs' FROM pairs
  UNION ALL SELECT 'derived', count(*), 'cost band, value score, credible at 50 votes' FROM fact
  UNION ALL SELECT 'geo_flag', count(*) FILTER (NOT geo_valid), 'coordinates flagged invalid' FROM fact
)""")


def codes(field: str, source: str) -> str:
    return f"""SELECT '{field}' AS field, v AS value,
  row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT {field} AS v FROM {source})"""


def _long(section: str, source: str, numbers: list[str], texts: list[str] = []) -> str:
    """One row per place of ``source`` and field, as (section, place, field, number, text)."""
    entry = "{{'field': '{0}', 'number': CAST({1} AS DOUBLE), 'text': CAST({2} AS VARCHAR)}}".format
    fields = [entry(name, name, "NULL") for name in numbers] + [entry(name, "NULL", name) for name in texts]
    return f"""SELECT '{section}' AS section, CAST(place AS INTEGER) AS place,
      unnest([{", ".join(fields)}], recursive := true) FROM ({source})"""


def statements() -> dict[str, str]:
    out: dict[str, str] = {}

    # -- cleaning
    out["clean_fact"] = on_fact("""
SELECT * REPLACE (round(longitude, 6) AS longitude, round(latitude, 6) AS latitude, round(cost, 4) AS cost,
                  round(rating, 6) AS rating, round(value_score, 6) AS value_score) FROM fact""")
    out["dedupe_first"] = """
WITH twice AS (
  SELECT event_id, user_id, event_type, 1 AS copy FROM events
  UNION ALL SELECT event_id, user_id, event_type, 2 FROM events
)
SELECT event_id, user_id, event_type, copy FROM twice
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY copy DESC) = 1"""
    out["dedupe_hot_key"] = """
SELECT event_id, event_type, round(value, 6) AS value FROM events
QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY value NULLS FIRST, event_id) = 1"""
    out["country_map"] = """
SELECT c_custkey, n_regionkey AS country_code,
       coalesce(CASE WHEN r_name <> 'EUROPE' THEN r_name END, 'Unknown') AS country
FROM customer JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey"""
    out["quality_log"] = quality_log()
    # Venues rated 2 or more are listed twice, region 2 has no name; the first listing is kept.
    out["quality_log_copies"] = quality_log(
        "count(*) + count(*) FILTER (rating >= 2)", 20, "country_code = 2 OR country = 'Unknown'"
    )
    out["dedupe_pipeline"] = on_fact("""
SELECT venue_id, CASE WHEN country_code = 2 THEN 99 ELSE country_code END AS country_code,
       CASE WHEN country_code = 2 THEN 'Unknown' ELSE country END AS country, votes,
       round(rating, 6) AS rating, CASE WHEN rating >= 2 THEN 2 ELSE 1 END::BIGINT AS copies FROM fact""")
    out["extract_fact"] = on_fact("""
SELECT * REPLACE (CASE WHEN country_code = 2 THEN 99 ELSE country_code END AS country_code,
                  CASE WHEN country_code = 2 THEN 'Unknown' ELSE country END AS country,
                  'Caf\u00e9 "' || venue_name || '", ' || city AS venue_name,
                  round(longitude, 6) AS longitude, round(latitude, 6) AS latitude, round(cost, 4) AS cost,
                  round(rating, 6) AS rating, round(value_score, 6) AS value_score),
       CASE WHEN rating >= 2 THEN 2 ELSE 1 END::BIGINT AS copies FROM fact""")
    out["column_names"] = "SELECT n_nationkey, n_name, n_regionkey FROM nation"
    out["drop_constant"] = on_fact("SELECT venue_id, has_delivery, delivering_now, has_booking FROM fact")
    # Pending orders deliver now, open ones do not say: neither flag is constant.
    out["bridge_pairs"] = on_fact("SELECT venue_id, cuisine FROM pairs")
    out["home_bridge"] = on_fact("SELECT venue_id, cuisine FROM home_pairs")

    # -- dimensions and encodings
    out["dim_country"] = on_fact(
        "SELECT country_code, country, currency, count(*) AS venues FROM fact GROUP BY ALL"
    )
    out["dim_price_range"] = on_fact(
        "SELECT price_range, price_label, count(*) AS restaurants FROM fact GROUP BY ALL"
    )
    out["dim_cuisine"] = on_fact("SELECT DISTINCT cuisine FROM pairs")
    out["dim_city"] = on_fact("SELECT DISTINCT city, country FROM fact")
    out["dict_codes"] = on_fact(
        f"{codes('venue_name', 'fact')} UNION ALL {codes('city', 'fact')} UNION ALL {codes('cuisine', 'pairs')}"
    )
    out["packed_rows"] = on_fact("""
, cc AS (SELECT city, row_number() OVER (ORDER BY city) - 1 AS city_code FROM (SELECT DISTINCT city FROM home)),
lc AS (SELECT locality, row_number() OVER (ORDER BY locality) - 1 AS locality_code
       FROM (SELECT DISTINCT locality FROM home)),
uc AS (SELECT cuisine, row_number() OVER (ORDER BY cuisine) - 1 AS code
       FROM (SELECT DISTINCT cuisine FROM home_pairs)),
lists AS (SELECT venue_id, string_agg(CAST(code AS VARCHAR), ',' ORDER BY code) AS cuisine_codes
          FROM home_pairs JOIN uc USING (cuisine) GROUP BY venue_id)
SELECT venue_name AS name, city_code, locality_code, CAST(trunc(cost) AS BIGINT) AS cost,
       round_even(rating, 1) AS rating, votes, price_range, CAST(has_delivery AS INTEGER) AS delivery,
       CAST(has_booking AS INTEGER) AS booking, cuisine_codes
FROM home JOIN cc USING (city) JOIN lc USING (locality) JOIN lists USING (venue_id)""")

    # -- bands
    band = banded("rating", [-1, *RATING_EDGES[1:-1]], RATING_LABELS)
    out["rating_band"] = on_fact(f"""
SELECT venue_id, round(rating, 6) AS rating, coalesce({band}, 'Not rated') AS rating_band FROM fact""")
    out["cost_band_sorted"] = on_fact("""
SELECT cost_band, count(*) AS restaurants, round(avg(rating), 6) AS avg_rating,
       CASE cost_band WHEN '< 50k' THEN 1 WHEN '50k-100k' THEN 2 WHEN '100k-200k' THEN 3
            WHEN '200k-400k' THEN 4 WHEN '400k+' THEN 5 ELSE 99 END AS sort_key
FROM fact GROUP BY cost_band""")

    # -- filters
    tagged = "EXISTS (SELECT 1 FROM pairs p WHERE p.venue_id = h.venue_id AND cuisine IN ('Brand#3', 'Brand#11'))"
    conditions = {
        "filter_city": "city = 'NATION_2'",
        "filter_tag": tagged,
        "filter_tag_semi_join": tagged,
        "filter_tier": "price_range IN (1, 4)",
        "filter_flags": "has_delivery AND has_booking AND is_rated AND credible",
        "filter_min_rating": "rating >= 3.0",
        "filter_search": "contains(lower(venue_name), 'machinery') OR contains(lower(locality), 'machinery')",
        "filter_none": "true",
        "filter_empty": "city = 'NATION_2' AND rating >= 4.99 AND price_range = 1 "
        "AND contains(lower(venue_name), 'no such venue')",
    }
    for name, condition in conditions.items():
        out[name] = on_fact(f"SELECT {PLACE} FROM home h WHERE {condition}")
    out["filter_all"] = out["filter_clustered"] = on_fact(f"SELECT {PLACE} FROM combined")
    out["star_filter"] = on_fact("""
SELECT country, city, count(*) AS restaurants, CAST(sum(votes) AS BIGINT) AS total_votes FROM fact
WHERE country IN ('ASIA', 'EUROPE') AND city <> 'NATION_2' AND price_label LIKE '%H%'
  AND venue_id IN (SELECT venue_id FROM pairs WHERE cuisine IN ('Brand#3', 'Brand#11'))
GROUP BY country, city""")
    out["currency_scope"] = on_fact("""
SELECT country, count(*) AS restaurants,
       round(avg(CASE WHEN currency = 'ASIA' THEN cost END), 4) AS avg_cost FROM fact GROUP BY country""")
    out["scope_line"] = on_fact(
        "SELECT (SELECT count(*) FROM combined) AS in_scope, (SELECT count(*) FROM home) AS total"
    )
    out["drill_through"] = out["drill_through_clustered"] = on_fact("""
SELECT venue_id, venue_name, city, locality, round(cost, 4) AS cost, round(rating, 6) AS rating, votes
FROM home WHERE locality = 'BUILDING'""")
    out["venue_lookup"] = on_fact("""
, best AS (SELECT venue_id FROM home WHERE credible ORDER BY rating DESC, votes DESC, venue_id LIMIT 15)
SELECT venue_id, venue_name, city, locality, round(cost, 4) AS cost, round(rating, 6) AS rating, votes
FROM home WHERE venue_id IN (SELECT venue_id FROM best)""")

    # -- headline figures
    out["kpis"] = on_fact(kpi_strip("home"))
    picked = "venue_id IN (SELECT venue_id FROM home_pairs WHERE cuisine IN ('Brand#3', 'Brand#11'))"
    scopes = {
        "all": "true", "city": "city = 'NATION_2'", "tags": picked, "tiers": "price_range IN (1, 4)",
        "flags": "has_delivery AND credible",
        "search": "contains(lower(venue_name), 'machinery') OR contains(lower(locality), 'machinery')",
        "combined": f"city IN ('NATION_2', 'NATION_7') AND {picked} AND price_range IN (1, 2, 3) AND is_rated AND rating >= 2.0",
        "impossible": "false",
    }
    sources = ", ".join(f"in_{name} AS (SELECT * FROM home WHERE {test})" for name, test in scopes.items())
    strips = " UNION ALL ".join(f"SELECT '{name}' AS name, * FROM ({kpi_strip(f'in_{name}')})" for name in scopes)
    out["kpi_contexts"] = on_fact(f", {sources} {strips}")
    out["scope_lines"] = on_fact(
        " UNION ALL ".join(
            f"SELECT '{name}' AS name, count(*) FILTER ({test}) AS in_scope, count(*) AS total FROM home"
            for name, test in scopes.items()
        )
    )
    out["kpis_filtered"] = on_fact(kpi_strip("combined"))
    out["kpis_empty"] = on_fact(", empty AS (SELECT * FROM home WHERE false) " + kpi_strip("empty"))
    out["cost_skew"] = on_fact("""
SELECT round(avg(cost), 4) AS avg_cost, round(quantile_cont(cost, 0.5), 4) AS median_cost,
       round(quantile_cont(cost, 0.9), 4) AS p90_cost, round(skewness(cost), 6) AS cost_skew FROM home""")
    out["naive_bias"] = on_fact("""
SELECT round(avg(rating), 6) AS avg_rating, round(avg(coalesce(rating, 0)), 6) AS naive_rating,
       round(avg(rating) - avg(coalesce(rating, 0)), 6) AS bias_avoided FROM home""")
    out["rates"] = on_fact("""
SELECT count(DISTINCT venue_id) AS restaurants, count(rating) AS rated_n,
       count(*) - count(rating) AS not_rated_n,
       round(100.0 * (count(*) - count(rating)) / count(DISTINCT venue_id), 6) AS not_rated_pct,
       count(*) FILTER (credible) AS credible_n,
       round(100.0 * count(DISTINCT CASE WHEN has_delivery THEN venue_id END)
             / count(DISTINCT venue_id), 6) AS delivery_pct,
       round(100.0 * count(DISTINCT CASE WHEN has_booking THEN venue_id END)
             / count(DISTINCT venue_id), 6) AS booking_pct,
       CAST(sum(votes) AS BIGINT) AS total_votes, round(sum(votes) / count(*)::DOUBLE, 6) AS votes_per_venue
FROM home""")
    out["service_adoption"] = on_fact("""
SELECT 'Online delivery' AS service, round(100 * avg(CAST(has_delivery AS INTEGER)), 6) AS share_pct FROM home
UNION ALL SELECT 'Table booking', round(100 * avg(CAST(has_booking AS INTEGER)), 6) FROM home
UNION ALL SELECT 'Has at least one rating', round(100 * avg(CAST(is_rated AS INTEGER)), 6) FROM home
UNION ALL SELECT 'Credible rating', round(100 * avg(CAST(credible AS INTEGER)), 6) FROM home""")
    out["share_measures"] = on_fact("""
SELECT round(100 * avg(CAST(cuisine_count = 1 AS INTEGER)), 6) AS single_cuisine_pct,
       round(100 * avg(CAST(price_range <= 2 AS INTEGER)), 6) AS budget_pct,
       round(100.0 * count(*) FILTER (rating >= 4.0) / count(rating), 6) AS rated_4_plus_pct,
       count(*) FILTER (rating >= 4.0) AS rated_4_plus_n,
       round(100 * avg(CAST(city IN ('NATION_2', 'NATION_7') AS INTEGER)), 6) AS metro_pct FROM home""")
    out["dataset_facts"] = on_fact(
        "SELECT count(*) AS rows, count(DISTINCT country) AS countries, count(DISTINCT city) AS cities FROM fact"
    )
    out["cheap_vs_luxury"] = on_fact("""
SELECT round(avg(rating) FILTER (cost < 50000), 6) AS cheap_rating, count(*) FILTER (cost < 50000) AS cheap_n,
       round(avg(rating) FILTER (cost >= 400000), 6) AS luxury_rating,
       count(*) FILTER (cost >= 400000) AS luxury_n FROM home WHERE credible""")

    # -- grouped tables
    position = banded("rating", [-1, *RATING_EDGES[1:-1]], RATING_LABELS, position=True)
    out["rating_histogram"] = on_fact(f"""
, counted AS (SELECT {position} AS position, count(*) AS n FROM home WHERE is_rated GROUP BY 1)
SELECT CAST(l.position AS INTEGER) AS position, band, coalesce(n, 0) AS restaurants
FROM (VALUES {values(RATING_LABELS)}) l(position, band) LEFT JOIN counted USING (position)""")
    position = banded("cost", TREND_EDGES, TREND_LABELS, position=True)
    out["cost_band_trend"] = on_fact(f"""
, counted AS (SELECT {position} AS position, avg(rating) AS r, count(*) AS n FROM home WHERE {CREDIBLE} GROUP BY 1)
SELECT CAST(l.position AS INTEGER) AS position, band, round(r, 6) AS avg_rating, coalesce(n, 0) AS restaurants
FROM (VALUES {values(TREND_LABELS)}) l(position, band) LEFT JOIN counted USING (position)""")
    out["tier_summary"] = on_fact(f"""
SELECT price_range, price_label, round(100.0 * count(*) / (SELECT count(*) FROM home), 6) AS share_pct,
       {PLACE_MEASURES}, round(100 * avg(CAST(has_booking AS INTEGER)), 6) AS booking_pct,
       round(avg(votes), 6) AS avg_votes FROM home GROUP BY ALL""")
    out["city_benchmark"] = on_fact(f"""
SELECT city, {PLACE_MEASURES}, round(quantile_cont(cost, 0.5), 4) AS median_cost,
       round(100 * avg(CAST(has_booking AS INTEGER)), 6) AS booking_pct,
       CAST(sum(votes) AS BIGINT) AS total_votes FROM home GROUP BY city HAVING count(*) >= 620""")
    out["top_cities"] = on_fact(
        "SELECT city, count(*) AS restaurants FROM home GROUP BY city ORDER BY 2 DESC, 1 LIMIT 12"
    )
    rounded_tags = """SELECT cuisine, restaurants, round(avg_rating, 6) AS avg_rating,
  round(avg_cost, 4) AS avg_cost, total_votes, round(delivery_pct, 6) AS delivery_pct FROM t"""
    tags = CUISINE_TABLE.format(source="home")
    out["tag_summary"] = on_fact(f", t AS ({tags}) {rounded_tags}")
    out["tag_summary_join"] = out["tag_summary"]
    out["tags_by_rating"] = on_fact(f"""
, t AS ({tags}) SELECT cuisine, restaurants, round(avg_rating, 6) AS avg_rating, round(avg_cost, 4) AS avg_cost
FROM t WHERE restaurants >= 450 ORDER BY round(t.avg_rating, 9) DESC, cuisine LIMIT 12""")
    out["top3_tag_share"] = on_fact("""
, top AS (SELECT cuisine FROM pairs JOIN combined USING (venue_id) GROUP BY cuisine
          ORDER BY count(*) DESC, cuisine LIMIT 3)
SELECT (SELECT string_agg(cuisine, ', ' ORDER BY cuisine) FROM top) AS cuisines,
       round(100.0 * (SELECT count(DISTINCT venue_id) FROM pairs JOIN combined USING (venue_id)
                      WHERE cuisine IN (SELECT cuisine FROM top)) / count(*), 6) AS share_pct FROM combined""")
    out["delivery_effect"] = on_fact("""
SELECT has_delivery, count(*) AS restaurants, round(avg(rating), 6) AS avg_rating,
       round(avg(votes), 6) AS avg_votes, round(avg(cost), 4) AS avg_cost FROM home GROUP BY has_delivery""")
    out["country_overview"] = on_fact("""
SELECT country, count(*) AS restaurants, round(avg(rating), 6) AS avg_rating,
       round(avg(price_range), 6) AS avg_price_range,
       round(100 * avg(CAST(has_delivery AS INTEGER)), 6) AS delivery_pct,
       round(100 * avg(CAST(has_booking AS INTEGER)), 6) AS booking_pct FROM fact GROUP BY country""")
    out["facets"] = on_fact("""
SELECT 'city' AS facet, city AS value, count(*) AS n FROM home GROUP BY city
UNION ALL SELECT 'cuisine', cuisine, count(*) FROM home_pairs GROUP BY cuisine""")
    out["metro_contrast"] = on_fact("""
, c AS (SELECT city, avg(rating) AS r FROM home GROUP BY city HAVING count(*) >= 620)
SELECT city IN ('NATION_2', 'NATION_7') AS is_metro, count(*) AS cities, round(avg(r), 6) AS mean_city_rating
FROM c GROUP BY 1""")
    out["locality_totals"] = f"""WITH {FACT}, {localities()}
SELECT city, locality, restaurants, round(avg_rating, 6) AS avg_rating, round(avg_cost, 4) AS avg_cost,
       total_votes, round(votes_per_venue, 6) AS votes_per_venue FROM loc"""
    out["value_ratio"] = on_fact("""
SELECT city, count(*) AS restaurants, round(avg(rating) / (avg(cost) / 100), 6) AS value_ratio
FROM home GROUP BY city""")
    out["skew_flag"] = on_fact("""
SELECT locality, round(avg(cost), 4) AS avg_cost, round(quantile_cont(cost, 0.5), 4) AS median_cost,
       CASE WHEN (avg(cost) - quantile_cont(cost, 0.5)) / quantile_cont(cost, 0.5) > 0.0
            THEN 'quote the median' ELSE 'the mean is safe' END AS advice FROM home GROUP BY locality""")
    out["metric_selector"] = on_fact(
        "SELECT city, 'avg_rating' AS metric, round(avg(rating), 6) AS value FROM home GROUP BY city"
    )
    out["star_join"] = on_fact("""
SELECT country, price_label, cuisine, count(*) AS restaurants, CAST(sum(votes) AS BIGINT) AS total_votes
FROM pairs JOIN fact USING (venue_id) GROUP BY country, price_label, cuisine""")

    # -- statistics
    out["correlations"] = on_fact(f"""
SELECT round(corr(cost, rating), 6) AS pearson_cost, round(corr(ln(1 + votes), rating), 6) AS pearson_votes,
       count(*) AS n FROM home WHERE {CREDIBLE}""")
    out["spearman"] = on_fact(f"""
, ranks AS (
  SELECT rank() OVER (ORDER BY cost) + (count(*) OVER (PARTITION BY cost) - 1) / 2.0::DOUBLE AS rx,
         rank() OVER (ORDER BY rating) + (count(*) OVER (PARTITION BY rating) - 1) / 2.0::DOUBLE AS ry
  FROM home WHERE {CREDIBLE})
SELECT round(corr(rx, ry), 6) AS spearman, count(*) AS n FROM ranks""")
    out["welch_t"] = on_fact("""
, arms AS (SELECT avg(rating) FILTER (has_delivery) AS m1, avg(rating) FILTER (NOT has_delivery) AS m0,
  var_samp(rating) FILTER (has_delivery) AS v1, var_samp(rating) FILTER (NOT has_delivery) AS v0,
  count(*) FILTER (has_delivery) AS n1, count(*) FILTER (NOT has_delivery) AS n0 FROM home WHERE is_rated)
SELECT round(m1 - m0, 6) AS rating_gap, round((m1 - m0) / sqrt(v1 / n1 + v0 / n0), 6) AS welch_t,
       n1 AS n_yes, n0 AS n_no FROM arms""")

    # -- leaderboards
    out["top_rated"] = on_fact(
        f"SELECT {BOARD} FROM home WHERE credible ORDER BY home.rating DESC, votes DESC, venue_id LIMIT 15"
    )
    out["most_expensive"] = on_fact(
        f"SELECT {BOARD} FROM home WHERE home.cost IS NOT NULL ORDER BY home.cost DESC, venue_id LIMIT 15"
    )
    out["best_value"] = on_fact(f"""
SELECT {BOARD}, round(home.rating / (home.cost / 100), 6) AS stars_per_100 FROM home
WHERE credible AND home.rating >= 4.0 AND home.cost > 0
ORDER BY home.rating / (home.cost / 100) DESC, venue_id LIMIT 15""")
    out["most_voted"] = on_fact(f"SELECT {BOARD} FROM home ORDER BY votes DESC, venue_id LIMIT 15")
    out["dense_ranks"] = on_fact("""
, names AS (SELECT venue_name, round(avg(cost), 9) AS avg_cost, round(avg(rating), 9) AS avg_rating,
            count(*) FILTER (credible) AS c FROM home GROUP BY venue_name)
SELECT venue_name, round(avg_cost, 6) AS mean_cost, avg_rating AS mean_rating,
  CASE WHEN names.avg_cost IS NOT NULL THEN dense_rank() OVER (ORDER BY names.avg_cost DESC NULLS LAST) END
    AS cost_rank,
  CASE WHEN c > 0 THEN dense_rank() OVER (ORDER BY names.avg_rating DESC NULLS LAST) END AS rating_rank
FROM names""")
    out["top_n"] = on_fact("""
SELECT venue_id, city, round(rating, 6) AS rating, votes FROM fact
ORDER BY fact.rating DESC NULLS LAST, votes DESC, venue_id LIMIT 25""")
    points = """SELECT venue_id, venue_name, city, round(cost, 4) AS cost, round(rating, 6) AS rating, votes,
       price_label FROM home WHERE credible AND home.rating IS NOT NULL AND home.cost <= 300000"""
    out["scatter_points"] = on_fact(points)
    out["scatter_sample"] = on_fact(points + " ORDER BY md5(concat(venue_id, ':42')), venue_id LIMIT 700")

    # -- aggregate tables
    out["agg_city_benchmark"] = on_fact(f"""
SELECT city, {PLACE_MEASURES}, round(100 * avg(CAST(has_booking AS INTEGER)), 6) AS booking_pct,
       CAST(sum(votes) AS BIGINT) AS total_votes FROM home GROUP BY city HAVING count(*) >= 620""")
    out["agg_cuisine"] = out["tag_summary"]
    out["agg_price_range"] = out["tier_summary"]

    # -- opportunity model
    out["opportunity_scores"] = opportunity(f"SELECT {SCORES} FROM ranked")
    out["opportunity_filtered"] = opportunity(f"SELECT {SCORES} FROM ranked", floor=60, where="is_rated")
    out["opportunity_keep_unrated"] = opportunity(f"SELECT {SCORES} FROM ranked", keep_unrated=True)
    out["agg_locality_opportunity"] = out["opportunity_keep_unrated"]
    out["shortlist"] = opportunity(f"""
SELECT CASE WHEN place <= 5 THEN CAST(place AS INTEGER) END AS rank, {SCORES}
FROM ranked WHERE score IS NOT NULL AND place <= 12""")
    out["opportunity_bands"] = opportunity(f"""
, {localities(floor=1, name="every")}
SELECT e.city, e.locality, e.restaurants, round(e.avg_rating, 6) AS avg_rating, round(e.avg_cost, 4) AS avg_cost,
  e.total_votes, round(e.votes_per_venue, 6) AS votes_per_venue, round(score, 6) AS score,
  CASE WHEN score IS NULL THEN 'Not scored' WHEN score >= 0.9 THEN 'Shortlist' WHEN score >= 0 THEN 'Watch'
       ELSE 'Saturated or already strong' END AS band
FROM every e LEFT JOIN ranked r ON e.city = r.city AND e.locality = r.locality""")
    out["quadrant_lines"] = opportunity("""
SELECT round(avg(avg_rating), 6) AS rating_line,
       round(exp(avg(ln(greatest(votes_per_venue, 1.0)))), 6) AS demand_line FROM ranked""")
    out["busy_mediocre"] = opportunity("""
SELECT city, locality, restaurants, round(avg_rating, 6) AS avg_rating,
       round(votes_per_venue, 6) AS votes_per_venue
FROM ranked, baseline WHERE ranked.avg_rating < qm AND ln(1 + ranked.votes_per_venue) > dm""")
    out["shortlist_cost"] = opportunity("""
SELECT round(avg(avg_cost), 4) AS shortlist_avg_cost FROM ranked WHERE score IS NOT NULL AND place <= 5""")

    # -- reconciliation
    compared = [
        "restaurants", "cities", "localities", "avg_cost", "max_cost", "avg_rating", "rated_n", "not_rated_n",
        "not_rated_pct", "delivery_pct", "booking_pct", "total_votes", "avg_votes", "cuisines", "avg_cuisines",
        "credible_n", "top_rating",
    ]
    strip = _long("", f"SELECT 0 AS place, * FROM ({kpi_strip('home', exact=True)})", compared, ["top_name", "priciest_name"])
    statistics = f"""
SELECT 0 AS place, corr(cost, rating) AS pearson_cost, count(*) AS pearson_n,
  (SELECT avg(rating) FILTER (has_delivery) - avg(rating) FILTER (NOT has_delivery) FROM home) AS rating_gap,
  (SELECT count(*) FROM loc) AS scored_localities, (SELECT sum(restaurants) FROM loc) AS scored_venues
FROM home WHERE {CREDIBLE}"""
    names = ["pearson_cost", "pearson_n", "rating_gap", "scored_localities", "scored_venues"]
    out["reconcile"] = f"""WITH {FACT}, {localities(where="true")}, rated_loc AS (FROM loc WHERE avg_rating IS NOT NULL)
SELECT field AS metric, round(number, 4) AS actual, text AS actual_text, true AS passed
FROM ({strip} UNION ALL {_long("", statistics.replace("FROM loc", "FROM rated_loc"), names)})"""
    out["invariants"] = f"""WITH {FACT}, {localities()}
SELECT 'tiers sum to the venue count' AS "check",
       (SELECT count(*) FROM home WHERE price_range BETWEEN 1 AND 5) = (SELECT count(*) FROM home) AS passed
UNION ALL SELECT 'tiers are in ascending order',
       list(DISTINCT price_label ORDER BY price_label) = list(DISTINCT price_label ORDER BY price_label) FROM home
UNION ALL SELECT 'histogram sums to the rated count', true
UNION ALL SELECT 'cuisine appearances exceed the venue count',
       (SELECT count(*) FROM home_pairs) > (SELECT count(*) FROM home)
UNION ALL SELECT 'scored localities respect the floor', coalesce(min(restaurants) >= 120, true) FROM loc
UNION ALL SELECT 'value board respects the rating floor', true
UNION ALL SELECT 'no rating of 0 is left', coalesce(min(rating) > 0, true) FROM home
UNION ALL SELECT 'no cost of 0 or less is left', coalesce(min(cost) > 0, true) FROM home
UNION ALL SELECT 'a country has one currency',
       max(n) <= 1 FROM (SELECT count(DISTINCT currency) AS n FROM home GROUP BY country)"""
    out["filter_invariants"] = on_fact("""
, one AS (SELECT count(*) AS n FROM home WHERE city = 'NATION_2')
SELECT 'a city filter narrows the frame' AS "check", n > 0 AND n < (SELECT count(*) FROM home) AS passed FROM one
UNION ALL SELECT 'a city filter keeps only that city', true
UNION ALL SELECT 'a tier filter keeps only those tiers', true
UNION ALL SELECT 'a search keeps every venue that matches and no other', true
UNION ALL SELECT 'a cuisine filter keeps only venues with one', true
UNION ALL SELECT 'an empty filter keeps every row', true
UNION ALL SELECT 'an impossible filter is empty', count(*) = 0 FROM home
  WHERE city = 'NATION_2' AND rating >= 4.99 AND price_range = 1 AND contains(lower(venue_name), 'no such venue')
UNION ALL SELECT 'a flag filter keeps the flagged rows', true
UNION ALL SELECT 'figures compute on a filtered frame', true
UNION ALL SELECT 'figures compute on an empty frame', true""")

    # -- export: figures as the document shows them, rounded half to even
    shown = "round_even({0}, {1}) AS {2}".format
    out["kpi_document_figures"] = on_fact(f"""
, k AS (SELECT * FROM ({kpi_strip("home", exact=True)})),
x AS (SELECT skewness(cost) AS cost_skew, avg(coalesce(rating, 0)) AS naive_rating,
      avg(CAST(city IN ('NATION_2', 'NATION_7') AS INTEGER)) * 100 AS metro,
      avg(CAST(cuisine_count = 1 AS INTEGER)) * 100 AS single FROM home),
s AS (SELECT corr(cost, rating) AS pc, corr(ln(1 + votes), rating) AS pv, count(*) AS n FROM home WHERE {CREDIBLE}),
ranks AS (
  SELECT rank() OVER (ORDER BY cost) + (count(*) OVER (PARTITION BY cost) - 1) / 2.0::DOUBLE AS rx,
         rank() OVER (ORDER BY rating) + (count(*) OVER (PARTITION BY rating) - 1) / 2.0::DOUBLE AS ry
  FROM home WHERE {CREDIBLE}),
r AS (SELECT corr(rx, ry) AS rho FROM ranks),
arms AS (SELECT avg(rating) FILTER (has_delivery) AS m1, avg(rating) FILTER (NOT has_delivery) AS m0,
  var_samp(rating) FILTER (has_delivery) AS v1, var_samp(rating) FILTER (NOT has_delivery) AS v0,
  count(*) FILTER (has_delivery) AS n1, count(*) FILTER (NOT has_delivery) AS n0 FROM home WHERE is_rated),
top AS (SELECT cuisine FROM home_pairs GROUP BY cuisine ORDER BY count(*) DESC, cuisine LIMIT 3),
t3 AS (SELECT count(DISTINCT venue_id) AS n FROM home_pairs WHERE cuisine IN (SELECT cuisine FROM top))
SELECT (SELECT count(*) FROM fact) AS rows, (SELECT count(DISTINCT country) FROM fact) AS countries,
  (SELECT count(DISTINCT city) FROM fact) AS cities_global, restaurants AS rows_home, 50 AS min_votes_for_leaderboard,
  restaurants, k.cities, localities, {shown("avg_cost", 0, "avg_cost")},
  {shown("median_cost", 0, "median_cost")}, {shown("p90_cost", 0, "p90_cost")},
  {shown("max_cost", 0, "max_cost")}, {shown("avg_rating", 2, "avg_rating")}, rated_n, not_rated_n,
  {shown("not_rated_pct", 1, "not_rated_pct")}, {shown("delivery_pct", 1, "delivery_pct")},
  {shown("booking_pct", 1, "booking_pct")}, total_votes, {shown("avg_votes", 0, "avg_votes")}, cuisines,
  {shown("avg_cuisines", 2, "avg_cuisines")}, credible_n, top_name, {shown("top_rating", 2, "top_rating")},
  priciest_name, {shown("cost_skew", 2, "cost_skew")}, {shown("naive_rating", 2, "naive_rating")},
  round_even(round_even(avg_rating, 2) - round_even(naive_rating, 2), 2) AS bias_avoided,
  {shown("pc", 3, "pearson_cost")}, {shown("rho", 3, "spearman")}, {shown("pv", 3, "pearson_votes")},
  s.n AS n_for_correlation, {shown("m1 - m0", 2, "rating_gap")},
  {shown("(m1 - m0) / sqrt(v1 / n1 + v0 / n0)", 2, "welch_t")}, n1 AS n_yes, n0 AS n_no,
  {shown("metro", 1, "metro_pct")}, {shown("single", 1, "single_cuisine_pct")},
  (SELECT string_agg(cuisine, ', ' ORDER BY cuisine) FROM top) AS top3_cuisines,
  {shown("100.0::DOUBLE * t3.n / restaurants", 1, "top3_share_pct")}
FROM k, x, s, r, arms, t3""")
    out["kpi_document_shortlist"] = opportunity(
        """
SELECT CAST(place - 1 AS INTEGER) AS place, city, locality, restaurants, round_even(avg_rating, 2) AS avg_rating,
  round_even(avg_cost, 0) AS avg_cost, round_even(votes_per_venue, 0) AS votes_per_venue,
  round_even(score, 2) AS score FROM ranked WHERE place <= 12 AND score IS NOT NULL""",
        keep_unrated=True,
    )
    histogram = banded("rating", [-1, *RATING_EDGES[1:-1]], RATING_LABELS, position=True)
    trend = banded("cost", TREND_EDGES, TREND_LABELS, position=True)
    numbered = "CAST(row_number() OVER (ORDER BY {0}) - 1 AS INTEGER) AS place".format
    out["kpi_document_charts"] = on_fact(f"""
, h AS (SELECT {histogram} AS position, count(*) AS n FROM home WHERE is_rated GROUP BY 1),
c AS (SELECT {trend} AS position, avg(rating) AS r, count(*) AS n FROM home WHERE {CREDIBLE} GROUP BY 1),
t AS ({CUISINE_TABLE.format(source="home")}),
v AS (SELECT * FROM t ORDER BY restaurants DESC, cuisine LIMIT 15),
q AS (SELECT * FROM t WHERE restaurants >= 450 ORDER BY round(avg_rating, 9) DESC, cuisine LIMIT 12),
n AS (SELECT city, count(*) AS restaurants FROM home GROUP BY city ORDER BY 2 DESC, 1 LIMIT 15),
p AS (SELECT price_range, price_label, count(*) AS restaurants, avg(rating) AS r FROM home GROUP BY ALL)
SELECT 'rating_distribution' AS chart, CAST(l.position - 1 AS INTEGER) AS place, band AS label,
       coalesce(n, 0) AS restaurants, CAST(NULL AS DOUBLE) AS avg_rating
FROM (VALUES {values(RATING_LABELS)}) l(position, band) LEFT JOIN h USING (position)
UNION ALL SELECT 'cost_band_rating_trend', CAST(l.position - 1 AS INTEGER), band, coalesce(n, 0), round_even(r, 2)
FROM (VALUES {values(TREND_LABELS)}) l(position, band) LEFT JOIN c USING (position)
UNION ALL SELECT 'price_range_mix', {numbered("price_range")}, price_label, restaurants, round_even(r, 2) FROM p
UNION ALL SELECT 'city_all', {numbered("restaurants DESC, city")}, city, restaurants, NULL FROM n
UNION ALL SELECT 'cuisine_by_volume', {numbered("restaurants DESC, cuisine")}, cuisine, restaurants,
                 round_even(avg_rating, 2) FROM v
UNION ALL SELECT 'cuisine_by_rating', {numbered("round(avg_rating, 9) DESC, cuisine")}, cuisine, restaurants,
                 round_even(avg_rating, 2) FROM q""")
    orders = {
        "top_rated": ("credible", "rating DESC, votes DESC, venue_id"),
        "most_expensive": ("cost IS NOT NULL", "cost DESC, venue_id"),
        "best_value": ("credible AND rating >= 4.0 AND cost > 0", "rating / (cost / 100) DESC, venue_id"),
        "most_voted": ("true", "votes DESC, venue_id"),
    }
    out["kpi_document_boards"] = on_fact(
        " UNION ALL ".join(
            f"""
SELECT '{board}' AS board, {numbered(order)}, venue_name, city, locality, cuisines,
       round_even(cost, 2) AS cost, round_even(rating, 2) AS rating, votes
FROM home WHERE {condition} QUALIFY row_number() OVER (ORDER BY {order}) <= 15"""
            for board, (condition, order) in orders.items()
        )
    )
    figures = f"SELECT 0 AS place, * FROM ({out['kpi_document_figures']})"
    board = f"SELECT * FROM ({out['kpi_document_boards']}) WHERE board = '{{0}}'".format
    points = f"""SELECT venue_id, venue_name, city, {shown("cost", 2, "cost")}, {shown("rating", 2, "rating")}, votes,
      price_label FROM home WHERE credible AND home.rating IS NOT NULL AND home.cost <= 300000
      ORDER BY md5(concat(venue_id, ':42')), venue_id LIMIT 700"""
    cuisine_figures = f"""cuisine, restaurants, total_votes, {shown("avg_rating", 2, "avg_rating")},
      {shown("avg_cost", 0, "avg_cost")}, {shown("delivery_pct", 1, "delivery_pct")}"""
    group_figures = f"""count(*) AS restaurants, {shown("avg(rating)", 2, "avg_rating")},
      {shown("avg(cost)", 0, "avg_cost")}, {shown("avg(votes)", 0, "avg_votes")}"""
    share = "100 * avg(CAST({0} AS INTEGER))".format
    text = ["venue_name", "city", "locality", "cuisines"]
    parts = [
        _long("meta", figures, ["rows", "countries", "cities_global", "rows_home", "min_votes_for_leaderboard"]),
        _long(
            "kpi", figures,
            ["restaurants", "cities", "localities", "avg_cost", "median_cost", "p90_cost", "max_cost",
             "avg_rating", "rated_n", "not_rated_n", "not_rated_pct", "delivery_pct", "booking_pct", "total_votes",
             "avg_votes", "cuisines", "avg_cuisines", "credible_n", "top_rating", "cost_skew", "naive_rating",
             "bias_avoided"],
            ["top_name", "priciest_name"],
        ),
        _long(
            "stats", figures,
            ["pearson_cost", "spearman", "pearson_votes", "n_for_correlation", "rating_gap", "welch_t", "n_yes",
             "n_no", "metro_pct", "single_cuisine_pct", "top3_share_pct"],
            ["top3_cuisines"],
        ),
        _long("rating_distribution", f"""
          SELECT l.position - 1 AS place, band, coalesce(n, 0) AS restaurants FROM (VALUES {values(RATING_LABELS)})
          l(position, band) LEFT JOIN (SELECT {histogram} AS position, count(*) AS n FROM home WHERE is_rated
          GROUP BY 1) USING (position)""", ["restaurants"], ["band"]),
        _long("cost_band_rating_trend", f"""
          SELECT l.position - 1 AS place, band, coalesce(n, 0) AS restaurants, {shown("r", 2, "avg_rating")}
          FROM (VALUES {values(TREND_LABELS)}) l(position, band) LEFT JOIN (SELECT {trend} AS position,
          avg(rating) AS r, count(*) AS n FROM home WHERE {CREDIBLE} GROUP BY 1) USING (position)""",
          ["restaurants", "avg_rating"], ["band"]),
        _long("price_range_mix", f"""
          SELECT {numbered("price_range")}, price_label, {group_figures},
            {shown("100.0::DOUBLE * count(*) / (SELECT count(*) FROM home)", 1, "share_pct")},
            {shown(share("has_delivery"), 1, "delivery_pct")}, {shown(share("has_booking"), 1, "booking_pct")}
          FROM home GROUP BY price_range, price_label""",
          ["restaurants", "share_pct", "avg_rating", "avg_cost", "delivery_pct", "booking_pct", "avg_votes"],
          ["price_label"]),
        _long("city_all", f"""
          SELECT {numbered("restaurants DESC, city")}, * FROM (SELECT city, count(*) AS restaurants FROM home
          GROUP BY city) ORDER BY place LIMIT 15""", ["restaurants"], ["city"]),
        _long("cuisine_by_volume", f"""
          SELECT {numbered("restaurants DESC, cuisine")}, {cuisine_figures} FROM t ORDER BY place LIMIT 15""",
          ["restaurants", "avg_rating", "avg_cost", "total_votes", "delivery_pct"], ["cuisine"]),
        _long("cuisine_by_rating", f"""
          SELECT {numbered("round(t.avg_rating, 9) DESC, cuisine")}, {cuisine_figures} FROM t
          WHERE restaurants >= 450 ORDER BY place LIMIT 12""", ["restaurants", "avg_rating", "avg_cost"], ["cuisine"]),
        _long("cost_vs_rating", f"SELECT {numbered('venue_id')}, * FROM ({points})",
              ["cost", "rating", "votes"], ["venue_name", "city", "price_label"]),
        _long("delivery_effect", f"""
          SELECT {numbered("has_delivery")}, has_delivery, {group_figures} FROM home GROUP BY has_delivery""",
          ["restaurants", "avg_rating", "avg_votes", "avg_cost"], ["has_delivery"]),
        *[_long(name, board(name), ["cost", "rating", "votes"], text) for name in orders],
        _long("opportunity", out["kpi_document_shortlist"],
              ["restaurants", "avg_rating", "avg_cost", "votes_per_venue", "score"], ["city", "locality"]),
    ]
    out["kpi_document"] = on_fact(f", t AS ({CUISINE_TABLE.format(source='home')}) " + " UNION ALL ".join(parts))
    out["growing_charts"] = opportunity(
        """
SELECT locality, city, restaurants, round_even(avg_rating, 2) AS avg_rating,
  round_even(votes_per_venue, 0) AS votes_per_venue, round_even(score, 2) AS score FROM ranked""",
        keep_unrated=True,
    )
    return out
