"""The registered queries as SQL for an independent engine.

Each statement computes its result from the raw tables with plain windows,
joins and cross joins, and shares nothing with the Spark code but the names of
the result columns.
"""

CENTER_LAT, CENTER_LON = 40.4168, -3.7038


def _initcap(text: str) -> str:
    return (
        f"array_to_string(list_transform(string_split(lower({text}), ' '), "
        "lambda w: upper(w[1]) || w[2:]), ' ')"
    )


def _price(text: str) -> str:
    return (
        f"TRY_CAST(replace(replace(regexp_replace({text}, '[^0-9,.]', '', 'g'), '.', ''), ',', '.')"
        " AS DOUBLE)"
    )


def _area(text: str) -> str:
    return f"TRY_CAST(replace(nullif(regexp_extract({text}, '[0-9,]+', 0), ''), ',', '.') AS DOUBLE)"


def _rooms(text: str) -> str:
    return f"TRY_CAST(nullif(regexp_extract({text}, '[0-9]+', 0), '') AS INTEGER)"


def _distance(lat1, lon1, lat2, lon2) -> str:
    return (
        f"6371 * acos(greatest(-1.0::DOUBLE, least(1.0::DOUBLE, cos(radians({lat1})) * "
        f"cos(radians({lat2})) * cos(radians({lon2}) - radians({lon1})) + "
        f"sin(radians({lat1})) * sin(radians({lat2})))))"
    )


RAW = """
raw AS (
  SELECT
    CASE WHEN l_suppkey % 2 = 0 THEN 'portal_a' ELSE 'portal_b' END AS source,
    'https://listings.example/' || l_orderkey || '/' || l_linenumber AS url,
    p_name AS title,
    CASE WHEN l_linenumber = 7 AND l_tax = 0 THEN 'A consultar'
         ELSE translate(format('{:,.2f}', l_extendedprice), ',.', '.,') || ' €' END AS raw_price,
    CAST(l_quantity AS INTEGER) || ' m²' AS raw_area,
    CASE WHEN l_tax < 0.07 THEN l_linenumber || ' hab.' END AS raw_rooms,
    n_name || ' ' || p_type AS neighborhood,
    n_name AS district,
    CASE WHEN l_quantity <> 50
         THEN l_partkey % 1000 * 0.00018::DOUBLE + 40.35::DOUBLE END AS latitude,
    CASE WHEN l_quantity <> 50
         THEN l_orderkey % 1000 * 0.00022::DOUBLE + (-3.80)::DOUBLE END AS longitude,
    l_shipdate AS scraped_at,
    strftime(o_orderdate, '%Y-%m') AS scrape_date
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
)"""

PARSED = RAW + f""",
parsed AS (
  SELECT * EXCLUDE (title, neighborhood, district),
    {_price('raw_price')} AS price_eur, {_area('raw_area')} AS area_sqm,
    {_rooms('raw_rooms')} AS rooms,
    {_initcap('title')} AS title, {_initcap('neighborhood')} AS neighborhood,
    {_initcap('district')} AS district
  FROM raw
)"""

CLEAN = PARSED + """,
clean AS (
  SELECT source, url, title, price_eur, area_sqm, rooms, price_eur / area_sqm AS price_per_sqm,
    neighborhood, district, latitude, longitude, scraped_at, scrape_date
  FROM parsed WHERE price_eur > 0 AND area_sqm > 0
)"""

SILVER = CLEAN + """,
silver AS (
  SELECT * FROM clean
  QUALIFY row_number() OVER (PARTITION BY url, scrape_date ORDER BY
    scraped_at DESC NULLS LAST, source DESC NULLS LAST, title DESC NULLS LAST,
    price_eur DESC NULLS LAST, area_sqm DESC NULLS LAST, rooms DESC NULLS LAST,
    price_per_sqm DESC NULLS LAST, neighborhood DESC NULLS LAST, district DESC NULLS LAST,
    latitude DESC NULLS LAST, longitude DESC NULLS LAST) = 1
)"""

SCORED = SILVER + """,
averaged AS (
  SELECT *, avg(price_per_sqm) OVER w AS average, count(*) OVER w AS listing_count
  FROM silver WINDOW w AS (PARTITION BY neighborhood, scrape_date)
),
scored AS (
  SELECT *, round(greatest(-1.0::DOUBLE, least(1.0::DOUBLE, 1 - price_per_sqm / average)), 6) + 0.0
    AS opportunity_index
  FROM averaged
),
ranked AS (
  SELECT *, rank() OVER (PARTITION BY scrape_date ORDER BY opportunity_index DESC) AS rank
  FROM scored
)"""

GOLD = SCORED + """,
gold AS (
  SELECT * EXCLUDE (average, scraped_at, listing_count),
    floor(average * 10000 + 0.37::DOUBLE) / 10000 AS neighborhood_avg_price_per_sqm
  FROM ranked WHERE listing_count > 1
)"""

GAZETTEER = """
districts AS (
  SELECT """ + _initcap("n_name") + """ AS district,
    n_nationkey % 5 * 0.03::DOUBLE + 40.37::DOUBLE AS lat,
    floor(n_nationkey / 5) * 0.04::DOUBLE + (-3.78)::DOUBLE AS lon,
    n_nationkey * 40.0::DOUBLE + 1500.0::DOUBLE AS avg_price_sqm
  FROM nation
),
barrios AS (
  SELECT DISTINCT n_name || ' ' || p_type AS barrio, """ + _initcap("n_name") + """ AS district,
    n_nationkey % 5 * 0.03::DOUBLE + length(p_type) * 0.002::DOUBLE + 40.36::DOUBLE AS lat,
    floor(n_nationkey / 5) * 0.04::DOUBLE + (-3.785)::DOUBLE AS lon,
    n_nationkey * 30 + 800 AS price_min,
    n_nationkey * 50 + length(p_type) * 100 + 1800 AS price_max
  FROM part JOIN nation ON p_partkey % 25 = n_nationkey
),
places AS (
  SELECT lower(barrio) AS place, district, lat, lon, price_min, price_max FROM barrios
  UNION ALL
  SELECT lower(district), district, lat, lon,
    CAST(trunc(avg_price_sqm * 0.85::DOUBLE) AS INTEGER),
    CAST(trunc(avg_price_sqm * 1.15::DOUBLE) AS INTEGER)
  FROM districts WHERE lower(district) NOT IN (SELECT lower(barrio) FROM barrios)
)"""

INDEX_C = SILVER + "," + GAZETTEER + """,
referenced AS (
  SELECT s.*, d.avg_price_sqm AS reference_price_sqm,
    (1 - s.price_per_sqm / d.avg_price_sqm) * 100 AS percent
  FROM silver s LEFT JOIN districts d ON s.district = d.district
),
index_c AS (
  SELECT *, CASE WHEN percent IS NULL THEN NULL WHEN percent > 0 THEN round_even(percent * 100, 0) / 100
    ELSE 0.0::DOUBLE END AS opportunity_index
  FROM referenced
)"""

INCOMING = RAW + """,
incoming AS (
  SELECT url, scrape_date, source, title, nullif(raw_price, 'A consultar') AS raw_price, raw_area,
    raw_rooms, latitude, raw_area = '49 m²' AS bad_time,
    raw_price = 'A consultar' AS no_price, latitude IS NULL AS bad_latitude
  FROM raw
),
checked AS (
  SELECT *, concat_ws('; ',
    CASE WHEN no_price THEN 'raw_price missing' END,
    CASE WHEN bad_latitude THEN 'latitude not a number' END,
    CASE WHEN bad_time THEN 'scraped_at not a time' END) AS reject_reason
  FROM incoming
)"""

DEAL_COLUMNS = """source, url, title, price_eur, area_sqm, rooms, price_per_sqm, neighborhood,
  district, latitude, longitude, neighborhood_avg_price_per_sqm, opportunity_index, scrape_date"""

LATEST = "scrape_date = (SELECT max(scrape_date) FROM gold)"
BEST = "ORDER BY opportunity_index DESC, url, scrape_date"


def _with(tables: str, select: str) -> str:
    return f"WITH {tables.strip()}\n{select.strip()}"


def _parsed_texts(name: str, parse) -> str:
    texts = ("raw_price", "raw_area", "raw_rooms")
    return _with(RAW, "SELECT url, scrape_date, " + ", ".join(texts) + ", " + ", ".join(
        f"{parse(t)} AS {name}_of_{t}" for t in texts
    ) + " FROM raw")


def _deal_query(condition: str, n: int) -> str:
    return _with(GOLD, f"""SELECT {DEAL_COLUMNS} FROM gold
      WHERE opportunity_index > 0 AND {condition} {BEST} LIMIT {n}""")


#: Pages with the source that their host's domain stands for, and their menu entries.
SITES = r"""
sites AS (
  SELECT page_id, html, CASE regexp_extract(url, '^https?://[^/]*\.([a-z]+)(?:[/:]|$)', 1)
      WHEN 'com' THEN 'web' WHEN 'net' THEN 'menu' ELSE 'body' END AS source,
    regexp_extract_all(html, '<li><a href="([^"]*)">[^<]*</a></li>', 1) AS links,
    regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a></li>', 1) AS texts,
    replace(replace(replace(regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1),
      '&quot;', '"'), '&copy;', '©'), '&amp;', '&') AS head
  FROM pages)"""


def _place(text: str, part: int) -> str:
    return f"coalesce(nullif(trim(split_part({text}, ',', {part})), ''), 'Desconocido')"


def _site_records() -> str:
    """Cards of the three sources: every entry, the whole menu, the whole page."""
    menu_place = "texts[1]"
    return f"""
  SELECT page_id, unnest(range(len(links))) AS position, source,
    'https://listings.example' || unnest(links) AS url, unnest(texts) AS title, '' AS raw_price,
    '' AS raw_area, NULL::VARCHAR AS raw_rooms, 'Desconocido' AS neighborhood, 'Desconocido' AS district
  FROM sites WHERE source = 'web'
  UNION ALL
  SELECT page_id, 0, source, 'https://menus.example' || links[1], texts[1], texts[2], texts[1], NULL,
    {_place(menu_place, 1)}, {_place(menu_place, 2)}
  FROM sites WHERE source = 'menu' AND len(links) > 0
  UNION ALL
  SELECT page_id, 0, source, 'https://articles.example' || links[1], trim(head), texts[2], '', NULL,
    'Desconocido', 'Desconocido'
  FROM sites WHERE source = 'body' AND len(links) > 0"""


def _uniform(key: str, salt: str) -> str:
    return (
        f"(CAST('0x' || substr(md5('{salt}' || {key}), 1, 15) AS BIGINT) + 0.5::DOUBLE)"
        " / 1152921504606846976.0::DOUBLE"
    )


def statements() -> dict[str, str]:
    radius = _distance(f"{CENTER_LAT}::DOUBLE", f"{CENTER_LON}::DOUBLE", "latitude", "longitude")
    key = "(url || '@' || scrape_date)"
    hash60 = "CAST('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 15) AS BIGINT)"
    first_link = "regexp_extract(html, '<a href=\"([^\"]*)\"', 1)"
    menu = "regexp_extract_all(html, '<li><a href=\"([^\"]*)\">[^<]*</a></li>', 1)"
    menu_text = "regexp_extract_all(html, '<li><a href=\"[^\"]*\">([^<]*)</a></li>', 1)"
    the_link = "regexp_extract(html, '<a href=\"(/the)\"', 1)"
    body = (
        "lower(regexp_replace(regexp_extract(html, '(?is)<body[^>]*>(.*)$', 1),"
        " '(?is)<!--.*?-->|<[^>]*>', '', 'g'))"
    )
    title = "regexp_extract(html, '(?is)<title>(.*?)</title>', 1)"
    unescaped_title = (
        f"trim(replace(replace(replace({title}, '&quot;', '\"'), '&copy;', '©'), '&amp;', '&'))"
    )
    return {
        # Sources and sinks
        "q_raw_listings": _with(RAW, "SELECT * FROM raw"),
        "q_csv_scan": _with(INDEX_C, """
            SELECT title, CAST(trunc(price_eur) AS INTEGER) AS price, price_per_sqm,
              CAST(trunc(area_sqm) AS INTEGER) AS area_sqm, rooms,
              CASE WHEN rooms IS NOT NULL THEN greatest(1, rooms // 2) END AS bathrooms,
              neighborhood, district, latitude, longitude, opportunity_index, scrape_date
            FROM index_c"""),
        "q_bronze_scan": _with(INCOMING, """
            SELECT source, '2001-08-01' AS date, url, scrape_date, title, raw_price, raw_area,
              raw_rooms, latitude
            FROM checked WHERE reject_reason = ''"""),
        "q_validate_split": _with(INCOMING, """
            SELECT url, scrape_date, reject_reason = '' AS is_valid, reject_reason FROM checked"""),
        "q_ingest_retry": _with(INCOMING, """
            , taken AS (SELECT * FROM checked UNION ALL SELECT * FROM checked WHERE scrape_date < '1996')
            SELECT CASE WHEN reject_reason = '' THEN 'bronze' ELSE 'rejected' END AS sink, source,
              scrape_date, reject_reason AS reason, count(*) AS n
            FROM taken GROUP BY ALL"""),
        "q_cleaned_bounds": _with(PARSED, """
            , moved AS (SELECT CASE WHEN rooms = 1 THEN -price_eur ELSE price_eur END AS price_eur,
                CASE rooms WHEN 2 THEN 0.0 WHEN 3 THEN -area_sqm ELSE area_sqm END AS area_sqm,
                CASE WHEN rooms = 4 THEN -rooms ELSE rooms END AS rooms FROM parsed),
            reasons AS (SELECT concat_ws('; ',
              CASE WHEN price_eur IS NULL THEN 'price_eur missing' END,
              CASE WHEN price_eur < 0 THEN 'price_eur below 0' END,
              CASE WHEN area_sqm IS NULL THEN 'area_sqm missing' END,
              CASE WHEN area_sqm <= 0 THEN 'area_sqm not above 0' END,
              CASE WHEN rooms < 0 THEN 'rooms below 0' END,
              CASE WHEN price_eur / nullif(area_sqm, 0) IS NULL THEN 'price_per_sqm missing' END,
              CASE WHEN price_eur / nullif(area_sqm, 0) < 0 THEN 'price_per_sqm below 0' END) AS reject_reason
              FROM moved)
            SELECT reject_reason = '' AS is_valid, reject_reason, count(*) AS n
            FROM reasons GROUP BY ALL"""),
        "q_source_slug": """
            WITH named AS (SELECT p_brand || '. ' || p_name || CASE p_size % 3
              WHEN 0 THEN ' España' WHEN 1 THEN ' Espaßa 日本' ELSE '' END AS source FROM part)
            SELECT source, count(*) AS n,
              regexp_replace(lower(source), '[^\\p{L}\\p{N}_-]', '_', 'g') AS slug
            FROM named GROUP BY ALL""",
        "q_silver_roundtrip": _with(SILVER, """
            SELECT source, scrape_date, count(*) AS n, sum(price_eur::DECIMAL(18, 2))::DOUBLE AS price_sum,
              strftime(max(scraped_at), '%Y-%m-%d') AS last_day
            FROM silver GROUP BY source, scrape_date"""),
        "q_gold_roundtrip": _with(GOLD, "SELECT url, scrape_date, rank, opportunity_index FROM gold"),
        "q_gold_scan": _with(GOLD, """
            SELECT scrape_date, count(*) AS n, min(rank) AS first_rank,
              max(opportunity_index) AS best
            FROM gold GROUP BY scrape_date"""),
        "q_publish_count": _with(GOLD, "SELECT count(*) AS n FROM gold"),
        "q_publish_rollback": _with(GOLD, """
            , versions AS (
              SELECT 'first' AS reader, scrape_date, opportunity_index FROM gold
              UNION ALL SELECT 'second', scrape_date, CASE WHEN scrape_date < '1996'
                THEN -opportunity_index ELSE opportunity_index END
              FROM gold WHERE scrape_date <> '1998-03')
            SELECT reader, scrape_date, count(*) AS n,
              sum(CAST(round(opportunity_index * 1000000) AS BIGINT))::BIGINT AS total
            FROM versions GROUP BY ALL"""),
        "q_adhoc_sql": _with(GOLD, """
            SELECT district, count(*) AS n, max(opportunity_index) AS best FROM gold
            WHERE opportunity_index > 0.5 AND price_eur <= 50000 GROUP BY district"""),
        # Scalar functions
        "q_parse_price": _parsed_texts("price", _price),
        "q_parse_area": _parsed_texts("area", _area),
        "q_parse_rooms": _parsed_texts("rooms", _rooms),
        "q_price_per_sqm": _with(PARSED, """
            SELECT url, scrape_date, scraped_at, price_eur / CASE WHEN rooms = 7 THEN NULL
              ELSE area_sqm END AS price_per_sqm
            FROM parsed"""),
        "q_normalize_text": f"""
            SELECT p_partkey, CASE WHEN p_size <= 10 THEN 'Desconocido'
              ELSE {_initcap('p_name')} END AS title
            FROM part""",
        "q_split_location": _with(RAW, """
            , located AS (SELECT url, scrape_date, CASE WHEN raw_rooms IS NULL THEN neighborhood
              WHEN latitude IS NULL THEN '' WHEN raw_price = 'A consultar' THEN NULL
              ELSE neighborhood || ' , ' || district || ' , ' || source END AS location FROM raw)
            SELECT url, scrape_date, location,
              coalesce(nullif(trim(string_split(location, ',')[1]), ''), 'Desconocido')
                AS neighborhood,
              coalesce(nullif(trim(string_split(location, ',')[2]), ''), 'Desconocido') AS district
            FROM located"""),
        "q_absolute_url": f"""
            SELECT page_id, CASE WHEN {first_link} LIKE '/%'
                THEN 'https://listings.example' || {first_link} ELSE {first_link} END AS link_url,
              CASE WHEN url LIKE '/%' THEN 'https://listings.example' || url ELSE url END AS own_url
            FROM pages""",
        "q_synthetic_url": """
            SELECT o_orderkey, 'https://listings.example/inmueble/' || o_orderkey || '/' AS url
            FROM orders""",
        "q_default_date": _with(RAW, """
            SELECT url, CASE WHEN raw_rooms IS NULL OR latitude IS NULL
              THEN strftime(scraped_at, '%Y-%m-%d') ELSE scrape_date END AS scrape_date
            FROM raw"""),
        "q_opportunity_color": _with(GOLD, """
            SELECT url, scrape_date, '#' ||
              format('{:02x}', CAST(trunc(255 * (1 - greatest(0.0, least(1.0, opportunity_index))))
                AS INTEGER)) ||
              format('{:02x}', CAST(trunc(200 * greatest(0.0, least(1.0, opportunity_index)))
                AS INTEGER)) || '50' AS color
            FROM gold"""),
        "q_room_band": _with(SILVER, """
            SELECT url, scrape_date, area_sqm * 4 AS area,
              CASE WHEN area_sqm * 4 < 45 THEN 0 WHEN area_sqm * 4 < 70 THEN 1
                WHEN area_sqm * 4 < 100 THEN 2 WHEN area_sqm * 4 < 140 THEN 3 ELSE 4 END
                AS min_rooms,
              CASE WHEN area_sqm * 4 < 45 THEN 1 WHEN area_sqm * 4 < 70 THEN 2
                WHEN area_sqm * 4 < 100 THEN 3 WHEN area_sqm * 4 < 140 THEN 4 ELSE 5 END
                AS max_rooms,
              CASE WHEN rooms IS NOT NULL THEN greatest(1, rooms // 2) END AS bathrooms
            FROM silver"""),
        "q_distance": _with(SILVER, f"""
            SELECT url, scrape_date, CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL
              THEN round({radius}, 2) END AS distance_km
            FROM silver"""),
        "q_geo_jitter": _with(SILVER, f"""
            , drawn AS (SELECT *, sqrt(-2.0::DOUBLE * ln({_uniform(key, 'r')})) AS r,
                2.0::DOUBLE * pi() * {_uniform(key, 'a')} AS a
              FROM silver WHERE latitude IS NOT NULL AND longitude IS NOT NULL)
            SELECT url, scrape_date,
              round(latitude + r * cos(a) * (250 / 111320.0::DOUBLE), 6) AS lat,
              round(longitude + r * sin(a) * (250 / 111320.0::DOUBLE) / cos(radians(latitude)), 6)
                AS lon
            FROM drawn"""),
        # Filters and duplicates
        "q_valid_rows": _with(CLEAN, """
            SELECT url, scrape_date, scraped_at, price_eur, area_sqm, rooms FROM clean"""),
        "q_silver": _with(SILVER, "SELECT * FROM silver"),
        "q_dedup_latest": _with(RAW, """
            SELECT url, scrape_date, scraped_at, raw_price, raw_area, raw_rooms, source FROM raw
            QUALIFY row_number() OVER (PARTITION BY url, scrape_date ORDER BY
              scraped_at DESC NULLS LAST, source DESC NULLS LAST, title DESC NULLS LAST,
              raw_price DESC NULLS LAST, raw_area DESC NULLS LAST, raw_rooms DESC NULLS LAST,
              neighborhood DESC NULLS LAST, district DESC NULLS LAST) = 1"""),
        "q_dedup_stats": _with(CLEAN, """
            SELECT count(*) AS before, count(DISTINCT (url, scrape_date)) AS remaining,
              count(*) - count(DISTINCT (url, scrape_date)) AS removed
            FROM clean"""),
        "q_mappable": _with(GOLD, """
            SELECT url, scrape_date, latitude, longitude FROM gold
            WHERE latitude IS NOT NULL AND longitude IS NOT NULL"""),
        # Indexes and ranks
        "q_index_a": _with(GOLD, "SELECT * FROM gold"),
        "q_refreshed_silver": _with(SILVER, "SELECT * FROM silver"),
        "q_refreshed_gold": _with(GOLD, "SELECT * FROM gold"),
        "q_index_a_ranked_after": _with(SCORED, """
            SELECT url, scrape_date, opportunity_index,
              rank() OVER (PARTITION BY scrape_date ORDER BY opportunity_index DESC) AS rank
            FROM scored WHERE listing_count > 1"""),
        "q_deal_rank": _with(SCORED, """
            SELECT url, scrape_date, listing_count, opportunity_index, rank FROM ranked"""),
        "q_index_b": _with(SILVER, """
            , averages AS (SELECT neighborhood, avg(price_eur) AS average FROM silver GROUP BY 1)
            SELECT 'synthetic' AS source,
              'https://listings.example/inmueble/' || url || '-' || scrape_date || '/' AS url,
              title, price_eur, area_sqm, area_sqm AS area_m2,
              price_eur / area_sqm AS price_per_sqm, neighborhood, scrape_date,
              round((average - price_eur) / average, 6) + 0.0 AS opportunity_index,
              floor(average * 10000 + 0.37::DOUBLE) / 10000 AS avg_neighborhood_price
            FROM silver JOIN averages USING (neighborhood)"""),
        "q_index_c": _with(INDEX_C, """
            SELECT url, scrape_date, district, reference_price_sqm, opportunity_index
            FROM index_c"""),
        # Lookups and geography
        "q_gazetteer_lookup": _with(SILVER + "," + GAZETTEER, """
            , names AS (
              SELECT neighborhood AS name, count(*) AS listings FROM silver GROUP BY 1
              UNION ALL SELECT district, count(*) FROM silver GROUP BY 1
              UNION ALL SELECT source, count(*) FROM silver GROUP BY 1)
            SELECT name, listings, district AS place_district, round(lat, 6) AS place_lat,
              round(lon, 6) AS place_lon, price_min, price_max
            FROM names LEFT JOIN places ON lower(name) = place"""),
        "q_district_center": _with(SILVER + "," + GAZETTEER, """
            , named AS (SELECT url, scrape_date,
              CASE WHEN rooms = 3 THEN upper(district) ELSE district END AS district FROM silver)
            SELECT url, scrape_date, n.district, round(lat, 6) AS center_lat,
              round(lon, 6) AS center_lon
            FROM named n LEFT JOIN districts d ON n.district = d.district"""),
        "q_price_band": _with(SILVER + "," + GAZETTEER, """
            SELECT url, scrape_date, price_min, price_max,
              CASE WHEN price_per_sqm < price_min THEN 'below'
                WHEN price_per_sqm > price_max THEN 'above'
                WHEN price_min IS NOT NULL THEN 'in' END AS price_band
            FROM silver LEFT JOIN places ON lower(neighborhood) = place"""),
        "q_radius": _with(GOLD, f"""
            , near AS (SELECT *, {radius} AS distance FROM gold
              WHERE latitude IS NOT NULL AND longitude IS NOT NULL)
            SELECT {DEAL_COLUMNS}, round(distance, 2) AS distance_km FROM near
            WHERE distance <= 2.0 {BEST} LIMIT 50"""),
        "q_radius_all": _with(GOLD, f"""
            , near AS (SELECT *, {radius} AS distance FROM gold
              WHERE latitude IS NOT NULL AND longitude IS NOT NULL)
            SELECT url, scrape_date, round(distance, 2) AS distance_km FROM near
            WHERE distance <= 2.0"""),
        "q_radius_join": _with(SILVER + "," + GAZETTEER, f"""
            , pairs AS (
              SELECT d.district AS center, url, scrape_date,
                {_distance('d.lat', 'd.lon', 'latitude', 'longitude')} AS distance
              FROM silver CROSS JOIN districts d
              WHERE latitude IS NOT NULL AND longitude IS NOT NULL)
            SELECT center, url, scrape_date, round(distance, 2) AS distance_km
            FROM pairs WHERE distance <= 1.0"""),
        # Serving
        "q_top_deals": _deal_query(LATEST, 10),
        "q_top_deals_on_date": _deal_query("scrape_date = '1998-03'", 100),
        "q_search_deals": _deal_query(
            f"{LATEST} AND price_eur <= 60000 AND area_sqm >= 10 AND coalesce(rooms, 0) >= 2", 50
        ),
        "q_search_district": _deal_query(
            f"{LATEST} AND price_eur <= 60000 AND area_sqm >= 5 AND district = 'Nation_4'", 20
        ),
        "q_latest_snapshot": _with(SILVER, """
            SELECT url, scrape_date, price_eur, area_sqm FROM silver
            WHERE scrape_date = (SELECT max(scrape_date) FROM silver)"""),
        "q_latest_snapshot_of_rows": _with(SILVER, """
            SELECT url, scrape_date, price_eur, area_sqm FROM silver
            WHERE scrape_date = (SELECT max(scrape_date) FROM silver)"""),
        "q_neighborhood_avg": _with(SILVER, """
            SELECT neighborhood, floor(avg(price_eur) * 10000 + 0.37::DOUBLE) / 10000 AS avg_neighborhood_price,
              count(*) AS listing_count
            FROM silver GROUP BY neighborhood"""),
        "q_neighborhood_stats": _with(GOLD, f"""
            SELECT neighborhood, district, scrape_date,
              floor(avg(price_per_sqm) * 10000 + 0.37::DOUBLE) / 10000 AS avg_price_per_sqm,
              sum(CAST(round(opportunity_index * 1e6) AS BIGINT))::DOUBLE / count(*) / 1e6
                AS avg_opportunity_index,
              count(*) AS listing_count, min(price_eur) AS min_price_eur,
              max(price_eur) AS max_price_eur
            FROM gold WHERE {LATEST} GROUP BY neighborhood, district, scrape_date"""),
        "q_kpis": _with(GOLD, f"""
            SELECT max(opportunity_index) AS best_opportunity_index,
              floor(avg(price_eur) * 10000 + 0.37::DOUBLE) / 10000 AS avg_price_eur,
              floor(avg(price_per_sqm) * 10000 + 0.37::DOUBLE) / 10000 AS avg_price_per_sqm, count(*) AS total_listings
            FROM gold WHERE {LATEST} AND opportunity_index > 0"""),
        "q_top_neighborhoods": _with(GOLD, """
            SELECT neighborhood, floor(avg(price_per_sqm) * 10000 + 0.37::DOUBLE) / 10000 AS avg_price_per_sqm
            FROM gold GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"""),
        "q_dataset_summary": _with(INDEX_C, """
            SELECT count(*) AS listings, count(DISTINCT district) AS districts,
              count(DISTINCT neighborhood) AS neighborhoods,
              count(*) FILTER (opportunity_index > 0) AS opportunity_deals,
              floor(avg(price_per_sqm) * 10000 + 0.37::DOUBLE) / 10000 AS avg_price_per_sqm,
              round_even(count(*) FILTER (opportunity_index > 0) * 1000.0::DOUBLE / count(*), 0) / 10
                AS opportunity_share_pct
            FROM index_c"""),
        "q_deals_envelope": _with(GOLD, f"""
            , best AS (SELECT * FROM gold WHERE opportunity_index > 0 AND {LATEST} {BEST} LIMIT 10)
            SELECT count(*) AS total, max(scrape_date) AS scrape_date, string_agg(
              url || '=' || CAST(round(opportunity_index * 1e6) AS BIGINT), ';' {BEST}) AS deals
            FROM best"""),
        "q_require_rows": "SELECT p_partkey, p_name FROM part",
        "q_save_records": "SELECT n_nationkey, n_name FROM nation",
        "q_gold_replaced": _with(GOLD, """
            SELECT scrape_date, count(*) AS n FROM gold WHERE scrape_date <> '1998-03' GROUP BY 1"""),
        "q_all_places": "WITH " + GAZETTEER.strip() + """
            SELECT barrio AS place, district FROM barrios UNION SELECT district, NULL FROM districts""",
        "q_districts": _with(GOLD, "SELECT DISTINCT district FROM gold ORDER BY district"),
        # Extraction
        "q_extract_cards": f"""
            WITH menus AS (SELECT page_id, {menu} AS links, {menu_text} AS texts FROM pages),
            items AS (
              SELECT page_id, unnest(links) AS link, unnest(texts) AS text,
                generate_subscripts(links, 1) - 1 AS position
              FROM menus)
            SELECT page_id, position, 'web' AS source, 'https://listings.example' || link AS url,
              text AS title, '' AS raw_price, CAST(NULL AS VARCHAR) AS raw_rooms,
              'Desconocido' AS neighborhood, 'Desconocido' AS district
            FROM items""",
        "q_extract_listings": _with(SITES, _site_records()),
        "q_extract_fallback": """
            WITH found AS (
              SELECT page_id, regexp_extract_all(html, '<a href="/and">(.*?)</a>', 1) AS links,
                regexp_extract_all(html, '(?s)<h1>(.*?)</h1>', 1) AS heads
              FROM pages),
            chosen AS (SELECT page_id, CASE WHEN len(links) > 0 THEN links ELSE heads END AS cards
              FROM found)
            SELECT page_id, len(cards) AS cards, replace(replace(replace(
              cards[1], '&quot;', '"'), '&copy;', '©'), '&amp;', '&') AS first_card
            FROM chosen""",
        "q_next_page": f"""
            SELECT page_id, 'https://listings.example' || CASE WHEN {the_link} <> ''
              THEN {the_link} ELSE {first_link} END AS next_url
            FROM pages""",
        "q_next_listing_page": _with(SITES, f"""
            SELECT page_id, source, CASE source
              WHEN 'web' THEN 'https://listings.example' || CASE WHEN {the_link} <> '' THEN {the_link} ELSE links[1] END
              WHEN 'menu' THEN 'https://menus.example' || links[1]
              ELSE 'https://articles.example' || nullif({the_link}, '') END AS next_url
            FROM sites"""),
        "q_blocked_pages": f"""
            WITH reasons AS (SELECT page_id, CASE
              WHEN html LIKE '%<html lang="de"%' THEN 'CAPTCHA detected: html[lang=''de'']'
              WHEN contains({body}, 'ofthe') THEN 'Block text detected: ''Ofthe'''
              WHEN contains({body}, 'tionthat') THEN 'Block text detected: ''tionthat'''
              WHEN contains({body}, 'acceso') THEN 'Block text detected: ''acceso'''
              WHEN contains({title}, '403') OR contains({title}, 'The')
                THEN 'Block page title: ''' || {unescaped_title} || ''''
              ELSE '' END AS reason FROM pages)
            SELECT page_id, reason <> '' AS blocked, reason FROM reasons""",
        "q_blocked_defaults": f"""
            WITH kinds AS (SELECT page_id, page_id % 24 AS kind, {unescaped_title} AS title FROM pages),
            reasons AS (SELECT page_id, CASE
              WHEN kind <= 1 THEN 'CAPTCHA detected: iframe[src*=''captcha'']'
              WHEN kind = 2 THEN 'CAPTCHA detected: div[class*=''captcha'']'
              WHEN kind = 3 THEN 'CAPTCHA detected: div[id*=''captcha'']'
              WHEN kind = 4 THEN 'CAPTCHA detected: #challenge-running'
              WHEN kind IN (5, 19) THEN 'CAPTCHA detected: #challenge-form'
              WHEN kind = 6 THEN 'CAPTCHA detected: .cf-turnstile'
              WHEN kind <= 18 THEN 'Block text detected: ''' || list_extract([
                'Access Denied', 'acceso denegado', 'has sido bloqueado', 'you have been blocked',
                'too many requests', 'demasiadas solicitudes', 'Error 403', 'Error 429', 'rate limit',
                'please verify you are a human', 'verifica que eres humano', 'Error 403'], (kind - 6)::INT) || ''''
              WHEN kind = 21 THEN 'Block page title: ''403 ' || title || ''''
              WHEN kind = 22 THEN 'Block page title: ''Blocked: ' || title || ''''
              ELSE '' END AS reason FROM kinds)
            SELECT page_id, reason <> '' AS blocked, reason FROM reasons""",
        "q_block_reasons": f"""
            WITH reasons AS (SELECT regexp_matches(html, '(?i)(iframe|div)[^>]*captcha|challenge-|cf-turnstile')
              OR regexp_matches({body}, 'access denied|acceso denegado|has sido bloqueado|you have been blocked|too many requests|demasiadas solicitudes|error 403|error 429|rate limit|please verify you are a human|verifica que eres humano')
              OR regexp_matches({title}, '403|429|Access Denied|Blocked') AS blocked FROM pages)
            SELECT blocked, '' AS reason, count(*) AS n FROM reasons GROUP BY blocked""",
        "q_source_dispatch": _with(SITES + ", records AS (" + _site_records() + ")", """
            SELECT source, count(*) AS records, count(raw_rooms) AS with_rooms
            FROM records GROUP BY source"""),
        "q_union_sources": _with(RAW, """
            SELECT source, url, scrape_date, raw_price, scraped_at,
              CASE WHEN source = 'portal_b' THEN latitude END AS latitude,
              CASE WHEN source = 'portal_b' THEN longitude END AS longitude
            FROM raw"""),
        "q_unknown_sources": _with(SITES, """
            SELECT source, count(*) AS pages, 'menu, web' AS available
            FROM sites WHERE source = 'body' GROUP BY source"""),
        "q_readable_pages": f"""
            SELECT page_id FROM pages WHERE NOT (contains({title}, '403') OR contains({title}, 'The'))""",
        # Sampling
        "q_exact_sample": f"""
            SELECT o_orderkey, o_totalprice, true AS is_sampled FROM orders
            ORDER BY {hash60}, o_orderkey
            LIMIT (SELECT CAST(greatest(1, round_even(count(*) * 0.05::DOUBLE, 0)) AS BIGINT)
              FROM orders)""",
    }
