"""The same queries as SQL over the given tables.

``sql(final)`` puts the views the final select may use in front of it, in the
order raw -> records -> silver -> gold -> serving.
"""

from __future__ import annotations

from pyspark.sql.types import DecimalType, IntegerType, StructField, VarcharType

from catalog.views import ACCENTED, DEALS, DETAILS, RAW_STORES, STORES
from pricetide.schemas import DEFAULT_STORES, SERVING_OFFERS


def _text(x: str) -> str:
    """The shortest decimal text of a double, as a decimal: what is rounded half up."""
    return f"CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18))"


def _r(x: str, places: int) -> str:
    return f"CAST(round({_text(x)}, {places}) AS DOUBLE)"


def _avg(x: str, places: int) -> str:
    mean = f"CAST(sum(CAST({x} AS DECIMAL(18,6))) AS DOUBLE) / count({x})"
    return f"CAST(round(CAST({mean} AS DECIMAL(18,8)), {places}) AS DOUBLE)"


def _fit(x: str, precision: int, scale: int) -> str:
    rounded = f"round({_text(x)}, {scale})"
    return f"CAST(TRY_CAST({rounded} AS DECIMAL({precision},{scale})) AS DOUBLE)"


def _price(x: str, currency: str) -> str:
    amount = f"CAST(CAST(round({_text(x)}, 2) AS DECIMAL(28,2)) AS STRING)"
    symbol = f"CASE WHEN {currency} = 'BRL' THEN 'R$' ELSE '$' END"
    return f"CASE WHEN {x} IS NULL THEN '—' ELSE concat({symbol}, {amount}) END"


def _misfit(field: StructField) -> str:
    lost, long, x = "false", "false", field.name
    if isinstance(field.dataType, VarcharType):
        long = f"length({x}) > {field.dataType.length}"
    elif isinstance(field.dataType, DecimalType):
        fitted = _fit(x, field.dataType.precision, field.dataType.scale)
        lost = f"{x} IS NOT NULL AND {fitted} IS NULL"
    elif isinstance(field.dataType, IntegerType):
        lost = f"{x} IS NOT NULL AND TRY_CAST({x} AS INTEGER) IS NULL"
    count = "CAST(coalesce(sum(CASE WHEN {0} THEN 1 ELSE 0 END), 0) AS BIGINT) AS {1}"
    counts = f"{count.format(lost, 'n_lost')}, {count.format(long, 'n_too_long')}"
    return f"SELECT '{x}' AS column_name, {counts} FROM odd_offers"


MEASURES = f"""
  CAST(count(DISTINCT item_id) AS BIGINT) AS n_items,
  {_avg('discount_pct', 2)} AS avg_discount,
  {_avg('sale_price', 2)} AS avg_sale_price,
  {_avg('list_price', 2)} AS avg_list_price,
  {_r('max(discount_pct)', 2)} AS max_discount,
  {_avg('rating_pct', 1)} AS avg_rating
"""

LABEL = """
  CASE WHEN d.store_id IS NULL OR d.store_id = '' THEN NULL
       ELSE coalesce(s.store_name, concat('Loja ', d.store_id)) END
"""

TIER = """
  CASE WHEN discount_pct >= 75 THEN 'EXCELENTE' WHEN discount_pct >= 50 THEN 'BOA'
       WHEN discount_pct >= 25 THEN 'MEDIA' ELSE 'BAIXA' END
"""

VIEWS = {
    "deals": DEALS.format(lineitem="lineitem"),
    "details": DETAILS.format(part="part"),
    "stores": STORES.format(supplier="supplier"),
    "raw_stores": RAW_STORES.format(supplier="supplier"),
    "keyed": "SELECT * FROM deals WHERE item_id IS NOT NULL AND item_id <> ''",
    "ranked": """
        SELECT *, row_number() OVER (PARTITION BY snapshot_date, item_id ORDER BY ord1, ord2) AS rn
        FROM keyed
    """,
    "firsts": "SELECT * EXCLUDE (rn) FROM ranked WHERE rn = 1",
    "found": """
        SELECT f.*, t.* EXCLUDE (item_id, success)
        FROM firsts f JOIN details t ON f.item_id = t.item_id AND t.success
    """,
    "records": f"""
        SELECT d.*, {LABEL} AS store FROM found d LEFT JOIN stores s ON d.store_id = s.store_id
    """,
    "typed": """
        SELECT snapshot_date, item_id, ord1, ord2,
          coalesce(trim(name), 'DESCONHECIDO') AS name,
          TRY_CAST(sale_price AS DOUBLE) AS sale_price,
          TRY_CAST(list_price AS DOUBLE) AS list_price,
          'USD' AS offer_currency,
          TRY_CAST(discount AS DOUBLE) AS discount_pct,
          rating_label,
          TRY_CAST(rating_pct AS INTEGER) AS rating_pct,
          store,
          round(CAST(final_minor AS DOUBLE) / 100, 2) AS ref_price,
          round(CAST(initial_minor AS DOUBLE) / 100, 2) AS ref_list_price,
          currency AS ref_currency,
          CAST(ref_discount AS DOUBLE) AS ref_discount_pct
        FROM records
    """,
    "items": """
        SELECT * EXCLUDE (ord1, ord2) FROM typed
        WHERE item_id IS NOT NULL AND ref_currency IN ('BRL', 'USD')
    """,
    "raw_tags": """
        SELECT item_id, snapshot_date, tag1_id AS id, tag1_name AS description
        FROM records WHERE has_tags
        UNION ALL
        SELECT item_id, snapshot_date, tag2_id, tag2_name FROM records WHERE has_tags
    """,
    "tags": """
        SELECT DISTINCT item_id, TRY_CAST(id AS INTEGER) AS tag_id,
          coalesce(trim(description), 'DESCONHECIDO') AS tag_name, snapshot_date
        FROM raw_tags
    """,
    "raw_makers": """
        SELECT item_id, snapshot_date, maker1 AS maker FROM records WHERE has_makers
        UNION ALL
        SELECT item_id, snapshot_date, maker2 FROM records WHERE has_makers
    """,
    "makers": """
        SELECT DISTINCT item_id, coalesce(trim(maker), 'DESCONHECIDO') AS maker_name, snapshot_date
        FROM raw_makers
    """,
    "one_name": """
        SELECT item_id, snapshot_date, tag_id, min(tag_name) AS tag_name
        FROM tags GROUP BY item_id, snapshot_date, tag_id
    """,
    "joined_makers": """
        SELECT i.snapshot_date, i.item_id, discount_pct, sale_price, list_price, rating_pct,
          maker_name
        FROM items i JOIN makers m ON i.snapshot_date = m.snapshot_date AND i.item_id = m.item_id
    """,
    "joined_tags": """
        SELECT i.snapshot_date, i.item_id, discount_pct, sale_price, list_price, rating_pct,
          tag_id, tag_name
        FROM items i JOIN one_name t ON i.snapshot_date = t.snapshot_date AND i.item_id = t.item_id
    """,
    "rank_makers": f"""
        SELECT snapshot_date, maker_name, {MEASURES} FROM joined_makers
        GROUP BY snapshot_date, maker_name
    """,
    "rank_tags": f"""
        SELECT snapshot_date, tag_id, tag_name, {MEASURES} FROM joined_tags
        GROUP BY snapshot_date, tag_id, tag_name
    """,
    "history": f"""
        SELECT item_id, name, {_r('sale_price', 2)} AS sale_price,
          {_r('list_price', 2)} AS list_price, {_r('ref_price', 2)} AS ref_price, ref_currency,
          {_r('discount_pct', 2)} AS discount_pct, snapshot_date
        FROM items
    """,
    "offers": f"""
        SELECT item_id, name, sale_price, list_price, offer_currency, discount_pct, rating_label,
          rating_pct, store, ref_price, ref_list_price, ref_currency, snapshot_date,
          CASE WHEN ref_currency = 'USD' THEN {_r('ref_price - sale_price', 2)} END AS savings,
          {TIER} AS deal_tier
        FROM items
    """,
    "odd_offers": """
        SELECT * REPLACE (
          CASE WHEN right(item_id, 1) = '7' THEN concat(item_id, 'x') ELSE item_id END AS item_id,
          CASE WHEN right(item_id, 1) = '3' THEN sale_price * 1e9 ELSE sale_price END AS sale_price,
          CASE WHEN right(item_id, 2) = '11' THEN repeat(name, 40) ELSE name END AS name)
        FROM offers
    """,
    "serving_offers": f"""
        SELECT TRY_CAST(item_id AS INTEGER) AS item_id, name,
          {_fit('sale_price', 10, 2)} AS sale_price, {_fit('list_price', 10, 2)} AS list_price,
          offer_currency, {_fit('discount_pct', 5, 2)} AS discount_pct, rating_label, rating_pct,
          store, {_fit('ref_price', 10, 2)} AS ref_price,
          {_fit('ref_list_price', 10, 2)} AS ref_list_price, ref_currency,
          {_fit('savings', 10, 2)} AS savings, deal_tier, snapshot_date
        FROM offers
    """,
    "serving_history": f"""
        SELECT TRY_CAST(item_id AS INTEGER) AS item_id, name,
          {_fit('sale_price', 10, 2)} AS sale_price, {_fit('list_price', 10, 2)} AS list_price,
          {_fit('ref_price', 10, 2)} AS ref_price, ref_currency,
          {_fit('discount_pct', 5, 2)} AS discount_pct, snapshot_date
        FROM history
    """,
    "per_key": """
        SELECT d.snapshot_date, nullif(d.item_id, '') AS item_id, count(*) AS n,
          max(CASE WHEN t.item_id IS NULL THEN 0 ELSE 1 END) AS hit
        FROM deals d LEFT JOIN details t ON d.item_id = t.item_id AND t.success
        GROUP BY 1, 2
    """,
    "audit": """
        SELECT snapshot_date, CAST(sum(n) AS BIGINT) AS n_received,
          CAST(coalesce(sum(CASE WHEN item_id IS NULL THEN n END), 0) AS BIGINT) AS n_missing_key,
          CAST(coalesce(sum(CASE WHEN item_id IS NOT NULL THEN n - 1 END), 0) AS BIGINT)
            AS n_duplicate,
          CAST(sum(CASE WHEN item_id IS NOT NULL AND hit = 0 THEN 1 ELSE 0 END) AS BIGINT)
            AS n_lookup_failed,
          CAST(sum(CASE WHEN item_id IS NOT NULL AND hit = 1 THEN 1 ELSE 0 END) AS BIGINT)
            AS n_accepted
        FROM per_key GROUP BY snapshot_date
    """,
}

DEFAULTS = ", ".join(f"('{i}', '{n}')" for i, n in DEFAULT_STORES)

DEAL_COLUMNS = """
  snapshot_date, ord1, ord2, item_id, store_id, sale_price, list_price, discount, rating_label,
  rating_pct
"""
OFFER_REPORT = """
  item_id, name, store, sale_price, offer_currency, ref_price, ref_list_price, ref_currency,
  discount_pct, rating_label, rating_pct, deal_tier, savings, snapshot_date
"""
HISTORY_REPORT = """
  item_id, name, snapshot_date, sale_price, list_price, ref_price, ref_currency, discount_pct
"""
RANK_REPORT = "n_items, avg_discount, avg_sale_price, avg_list_price, max_discount, avg_rating"
RUN = """
  'run-1' AS run_id, '1.0.0' AS version, 'test' AS environment,
  'deals,details' AS sources, '2001-12-01 06:00:00' AS ingested_at
"""

NAMES = "SELECT DISTINCT coalesce(trim(name), 'DESCONHECIDO') AS name FROM details"

FINAL = {
    # sources and sinks
    "nested_envelope_roundtrip": """
        SELECT item_id, snapshot_date, ord2, name, sale_price, list_price, discount, rating_label,
          rating_pct, store, final_minor, currency, tag1_id, tag2_name, maker2
        FROM (SELECT item_id, snapshot_date, name, sale_price, list_price, discount, rating_label,
                rating_pct, store, final_minor, currency,
                CASE WHEN has_tags THEN tag1_id END AS tag1_id,
                CASE WHEN has_tags THEN tag2_name END AS tag2_name,
                CASE WHEN has_makers THEN maker2 END AS maker2 FROM records) r
        CROSS JOIN (VALUES (0), (1)) v(ord2)
    """,
    "bronze_lineage": f"""
        SELECT {DEAL_COLUMNS}, 'bronze_raw' AS layer, {RUN} FROM deals
    """,
    "enriched_lineage": f"""
        SELECT snapshot_date, item_id, name, sale_price, rating_label, store,
          'bronze_enriched' AS layer, {RUN} FROM records
    """,
    "read_snapshot": """
        SELECT * FROM items WHERE snapshot_date = DATE '1998-06-01'
    """,
    "snapshot_replace": f"""
        SELECT * FROM history WHERE snapshot_date >= DATE '1998-01-01'
        UNION ALL
        SELECT * REPLACE ({_r('sale_price', 0)} AS sale_price) FROM history
        WHERE snapshot_date < DATE '1998-01-01' AND year(snapshot_date) <> 1996
    """,
    "conform_schema": "SELECT * FROM serving_offers",
    "unique_violations": """
        SELECT snapshot_date, item_id, CAST(count(*) AS BIGINT) AS n_rows FROM deals
        GROUP BY snapshot_date, item_id HAVING count(*) > 1
    """,
    "csv_export": f"""
        SELECT {OFFER_REPORT} FROM serving_offers WHERE deal_tier IN ('EXCELENTE', 'BOA')
    """,
    "map_detail_explode": """
        SELECT item_id, success, name, currency, final_minor, initial_minor,
          CASE WHEN has_tags THEN tag1_id END AS tag1_id,
          CASE WHEN has_tags THEN tag1_name END AS tag1_name,
          CASE WHEN has_tags THEN tag2_id END AS tag2_id,
          CASE WHEN has_makers THEN maker1 END AS maker1,
          CASE WHEN has_makers THEN maker2 END AS maker2
        FROM details
    """,
    "landed_deals": """
        SELECT item_id, store_id, sale_price, list_price, discount, rating_label, rating_pct
        FROM deals
    """,
    "landed_stores": """
        SELECT CAST(store_id AS STRING) AS store_id, store_name FROM raw_stores
    """,
    "misfits": " UNION ALL ".join(map(_misfit, SERVING_OFFERS.fields)),
    # enrichment
    "require_key": f"SELECT {DEAL_COLUMNS} FROM keyed",
    "first_wins_dedupe": f"SELECT {DEAL_COLUMNS} FROM firsts",
    "detail_lookup_join": f"""
        SELECT {DEAL_COLUMNS}, name, currency, final_minor FROM found
    """,
    "store_label_join": f"""
        SELECT d.ord1, d.ord2, d.item_id, d.store_id, d.snapshot_date, {LABEL} AS store
        FROM deals d LEFT JOIN stores s ON d.store_id = s.store_id
    """,
    "store_dimension": """
        SELECT CAST(store_id AS STRING) AS store_id, arg_max(store_name, ord1) AS store_name
        FROM raw_stores GROUP BY store_id
    """,
    "store_label_default": f"""
        SELECT d.ord1, d.ord2, d.item_id, d.store_id, d.snapshot_date, {LABEL} AS store
        FROM deals d LEFT JOIN (VALUES {DEFAULTS}) s(store_id, store_name)
          ON d.store_id = s.store_id
    """,
    "rejection_audit": "SELECT * FROM audit",
    "run_manifest": f"""
        SELECT snapshot_date, n_received AS n_offers_received, n_accepted AS n_items_processed,
          n_accepted AS n_records, 'bronze_enriched' AS layer, {RUN}
        FROM audit
    """,
    # silver
    "silver_items": "SELECT *, '2001-12-01 07:00:00' AS processed_at FROM items",
    "typed_projection": "SELECT * EXCLUDE (ord1, ord2) FROM typed",
    "cast_losses": """
        SELECT 'sale_price' AS column_name, count(*) AS n_lost FROM deals
        WHERE sale_price IS NOT NULL AND TRY_CAST(sale_price AS DOUBLE) IS NULL
        UNION ALL
        SELECT 'list_price', count(*) FROM deals
        WHERE list_price IS NOT NULL AND TRY_CAST(list_price AS DOUBLE) IS NULL
        UNION ALL
        SELECT 'discount', count(*) FROM deals
        WHERE discount IS NOT NULL AND TRY_CAST(discount AS DOUBLE) IS NULL
        UNION ALL
        SELECT 'rating_pct', count(*) FROM deals
        WHERE rating_pct IS NOT NULL AND TRY_CAST(rating_pct AS INTEGER) IS NULL
    """,
    "minor_units": """
        SELECT item_id, round(CAST(final_minor AS DOUBLE) / 100, 2) AS ref_price,
          round(CAST(initial_minor AS DOUBLE) / 100, 2) AS ref_list_price
        FROM details
    """,
    "clean_name": """
        SELECT item_id, coalesce(trim(name), 'DESCONHECIDO') AS name,
          coalesce(trim(tag1_name), 'DESCONHECIDO') AS tag_name,
          coalesce(trim(maker2), 'DESCONHECIDO') AS maker_name
        FROM details
    """,
    "quality_filter": """
        SELECT item_id, name, currency AS ref_currency FROM details
        WHERE item_id IS NOT NULL AND currency IN ('BRL', 'USD')
    """,
    "keyed_dedupe": """
        SELECT item_id, snapshot_date, store_id, sale_price FROM (
          SELECT *, row_number() OVER (PARTITION BY item_id, snapshot_date
            ORDER BY ord1 DESC, ord2 DESC) AS rn FROM deals) WHERE rn = 1
    """,
    "tag_bridge": "SELECT *, '2001-12-01 07:00:00' AS processed_at FROM tags",
    "maker_bridge": "SELECT *, '2001-12-01 07:00:00' AS processed_at FROM makers",
    "layer_counts": """
        SELECT 'items' AS layer, count(*) AS n_rows FROM items
        UNION ALL SELECT 'tags', count(*) FROM tags
        UNION ALL SELECT 'makers', count(*) FROM makers
    """,
    "silver_items_repeated": "SELECT * FROM items",
    # joins and gold
    "history_repeated": "SELECT * FROM history",
    "rank_makers_joined": "SELECT * FROM rank_makers",
    "rank_tags_joined": "SELECT * FROM rank_tags",
    "join_makers": "SELECT * FROM joined_makers",
    "join_tags": """
        SELECT i.snapshot_date, i.item_id, discount_pct, sale_price, list_price, rating_pct,
          tag_id, tag_name
        FROM items i JOIN tags t ON i.snapshot_date = t.snapshot_date AND i.item_id = t.item_id
    """,
    "price_history": "SELECT * FROM history",
    "read_version": "SELECT * FROM history",
    "refused_write": "SELECT * FROM history",
    "history_lookup": "SELECT * FROM history WHERE item_id IN ('42', '777', '1000000')",
    "names_like": f"SELECT name FROM ({NAMES}) WHERE lower(name) LIKE lower('%RED %idge%')",
    "names_literal": f"SELECT name FROM ({NAMES}) WHERE contains(lower(name), lower('D GIZ'))",
    "names_regex": f"SELECT name FROM ({NAMES}) WHERE regexp_matches(name, '(?i)^[a-r].* gi[xz]mo')",
    "quarantined_deals": """
        SELECT 'deals' AS source,
          concat('{"steamAppID":"', coalesce(item_id, ''), '","storeID') AS text
        FROM deals WHERE ord1 % 50 = 7
    """,
    "audit_with_unreadable": """
        SELECT snapshot_date, CAST(sum(n) AS BIGINT) AS n_received,
          CAST(sum(CASE WHEN bad THEN n ELSE 0 END) AS BIGINT) AS n_unreadable,
          CAST(sum(CASE WHEN NOT bad AND item_id IS NULL THEN n ELSE 0 END) AS BIGINT) AS n_missing_key,
          CAST(sum(CASE WHEN item_id IS NOT NULL THEN n - 1 ELSE 0 END) AS BIGINT) AS n_duplicate,
          CAST(sum(CASE WHEN item_id IS NOT NULL AND hit = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_lookup_failed,
          CAST(sum(CASE WHEN item_id IS NOT NULL AND hit = 1 THEN 1 ELSE 0 END) AS BIGINT) AS n_accepted
        FROM (
          SELECT m.snapshot_date, bad, m.item_id, count(*) AS n,
            max(CASE WHEN t.item_id IS NULL THEN 0 ELSE 1 END) AS hit
          FROM (SELECT snapshot_date, ord1 % 50 = 7 AS bad,
              CASE WHEN ord1 % 50 <> 7 THEN nullif(item_id, '') END AS item_id FROM deals) m
            LEFT JOIN details t ON m.item_id = t.item_id AND t.success
          GROUP BY 1, 2, 3)
        GROUP BY snapshot_date
    """,
    "ledger_runs": """
        SELECT 1 AS run, count(*) AS n_deals FROM deals WHERE ord1 % 3 <> 0
        UNION ALL SELECT 2, count(*) FROM deals WHERE ord1 % 3 = 0
        UNION ALL SELECT 3, CAST(0 AS BIGINT)
    """,
    "rank_makers_range": f"""
        SELECT maker_name, {MEASURES} FROM joined_makers
        WHERE snapshot_date BETWEEN DATE '1995-03-01' AND DATE '1997-02-01' GROUP BY maker_name
    """,
    "rank_tags_range": f"""
        SELECT tag_id, tag_name, {MEASURES} FROM joined_tags
        WHERE snapshot_date BETWEEN DATE '1995-03-01' AND DATE '1997-02-01' GROUP BY tag_id, tag_name
    """,
    "offers": "SELECT * FROM offers",
    "savings": """
        SELECT item_id, snapshot_date, ref_currency, savings FROM offers
    """,
    "deal_tier": f"""
        SELECT ord1, ord2, item_id, snapshot_date, discount_pct, {TIER} AS deal_tier
        FROM (SELECT *, TRY_CAST(discount AS DOUBLE) AS discount_pct FROM deals)
    """,
    "rank_makers": "SELECT * FROM rank_makers",
    "rank_tags": "SELECT * FROM rank_tags",
    "latest_snapshot": f"""
        SELECT {DEAL_COLUMNS} FROM deals
        WHERE snapshot_date = (SELECT max(snapshot_date) FROM deals)
    """,
    "snapshot_label": """
        SELECT strftime(max(snapshot_date), '%d/%m/%Y') AS snapshot_label FROM deals
    """,
    "rank_aggregates": f"""
        SELECT snapshot_date, store_id, {MEASURES}
        FROM (SELECT snapshot_date, store_id, item_id, TRY_CAST(discount AS DOUBLE) AS discount_pct,
                TRY_CAST(sale_price AS DOUBLE) AS sale_price,
                TRY_CAST(list_price AS DOUBLE) AS list_price,
                TRY_CAST(rating_pct AS INTEGER) AS rating_pct FROM deals)
        GROUP BY snapshot_date, store_id
    """,
    # serving
    "best_offers": f"SELECT {OFFER_REPORT} FROM serving_offers",
    "top_tags": f"""
        SELECT tag_id, tag_name, {RANK_REPORT} FROM rank_tags
        WHERE snapshot_date = (SELECT max(snapshot_date) FROM items)
        ORDER BY n_items DESC, tag_name NULLS FIRST, tag_id NULLS FIRST LIMIT 15
    """,
    "top_makers": f"""
        SELECT maker_name, {RANK_REPORT} FROM rank_makers
        WHERE snapshot_date = (SELECT max(snapshot_date) FROM items)
        ORDER BY n_items DESC, maker_name LIMIT 20
    """,
    "all_tags": f"""
        SELECT tag_id, tag_name, {RANK_REPORT} FROM rank_tags
        WHERE snapshot_date = (SELECT max(snapshot_date) FROM items)
    """,
    "first_makers": f"""
        SELECT maker_name, {RANK_REPORT} FROM rank_makers
        WHERE snapshot_date = (SELECT max(snapshot_date) FROM items)
        ORDER BY n_items DESC, maker_name LIMIT 15
    """,
    "search_accents": f"""
        SELECT item_id, name FROM ({ACCENTED.format(part="part")})
        WHERE regexp_matches(name, '(?i)^[a-zé]*É[a-z]* .*É')
    """,
    "kpi_texts": f"""
        SELECT snapshot_date, n_offers, n_top_tier,
          concat(CAST(CAST(round(CAST(d AS DECIMAL(18,6)), 1) AS DECIMAL(18,1)) AS VARCHAR), '%')
            AS avg_discount,
          concat(CAST(CAST(round(CAST(r AS DECIMAL(18,6)), 0) AS DECIMAL(18,0)) AS VARCHAR), '%')
            AS avg_rating
        FROM (SELECT snapshot_date, CAST(count(*) AS BIGINT) AS n_offers,
                {_avg('discount_pct', 6)} AS d, {_avg('rating_pct', 6)} AS r,
                CAST(sum(CASE WHEN deal_tier = 'EXCELENTE' THEN 1 ELSE 0 END) AS BIGINT)
                  AS n_top_tier
              FROM serving_offers GROUP BY snapshot_date)
    """,
    "history_for_name": f"""
        SELECT {HISTORY_REPORT} FROM serving_history WHERE name ILIKE '%RED %g%'
    """,
    "history_for_item": f"""
        SELECT {HISTORY_REPORT} FROM serving_history WHERE item_id = 42
    """,
    "list_names": "SELECT DISTINCT name FROM serving_history",
    "search_regex": f"""
        SELECT {OFFER_REPORT} FROM serving_offers WHERE regexp_matches(name, '(?i)^(RED|blue) .*g')
    """,
    "tier_filter": f"""
        SELECT {OFFER_REPORT} FROM serving_offers WHERE deal_tier IN ('EXCELENTE', 'BOA')
    """,
    "filter_coverage": """
        SELECT snapshot_date,
          CAST(sum(CASE WHEN ok THEN 1 ELSE 0 END) AS BIGINT) AS n_shown,
          CAST(count(*) AS BIGINT) AS n_total,
          CAST(sum(CASE WHEN ok THEN 0 ELSE 1 END) AS BIGINT) AS n_hidden
        FROM (SELECT snapshot_date, regexp_matches(name, '(?i)ring')
                AND deal_tier IN ('EXCELENTE', 'BOA') AS ok FROM serving_offers)
        GROUP BY snapshot_date
    """,
    "search_literal": """
        SELECT DISTINCT name FROM serving_history WHERE contains(lower(name), lower('D G'))
    """,
    "format_price": f"""
        SELECT item_id, {_price('ref_price', 'ref_currency')} AS ref_text
        FROM (SELECT item_id, currency AS ref_currency, CAST(final_minor AS DOUBLE) / 100
                AS ref_price FROM details)
    """,
    "offer_display": f"""
        SELECT name, store, {_price('sale_price', "'USD'")} AS sale_text,
          {_price('ref_price', 'ref_currency')} AS ref_text,
          {_price('ref_list_price', 'ref_currency')} AS ref_list_text,
          discount_pct, rating_label, deal_tier
        FROM serving_offers
    """,
    "history_display": f"""
        SELECT snapshot_date, {_price('sale_price', "'USD'")} AS sale_text,
          {_price('list_price', "'USD'")} AS list_text,
          {_price('ref_price', 'ref_currency')} AS ref_text, ref_currency, discount_pct
        FROM serving_history
    """,
    "kpis": f"""
        SELECT snapshot_date, CAST(count(*) AS BIGINT) AS n_offers,
          {_avg('discount_pct', 6)} AS avg_discount, {_avg('rating_pct', 6)} AS avg_rating,
          CAST(sum(CASE WHEN deal_tier = 'EXCELENTE' THEN 1 ELSE 0 END) AS BIGINT) AS n_top_tier
        FROM serving_offers GROUP BY snapshot_date
    """,
    "tier_distribution": """
        SELECT snapshot_date, deal_tier, CAST(count(*) AS BIGINT) AS n_offers
        FROM serving_offers GROUP BY snapshot_date, deal_tier
    """,
    "quadrant": """
        SELECT snapshot_date, item_id, name, store, discount_pct, rating_pct, deal_tier,
          CASE WHEN discount_pct >= 50 AND rating_pct >= 70 THEN 'best_deal'
               WHEN discount_pct >= 50 THEN 'high_discount'
               WHEN rating_pct >= 70 THEN 'high_rating' ELSE 'low' END AS quadrant
        FROM serving_offers WHERE discount_pct IS NOT NULL AND rating_pct IS NOT NULL
    """,
    "history_series_info": """
        SELECT item_id, count(ref_price) > 0 AS has_ref_price,
          CASE WHEN count(ref_currency) > 0 THEN arg_min(ref_currency, snapshot_date) ELSE '' END
            AS series_currency
        FROM serving_history GROUP BY item_id
    """,
}


def sql(final: str) -> str:
    views = ",\n".join(f"{name} AS ({body})" for name, body in VIEWS.items())
    return f"WITH {views}\n{final}"


def oracle_sql() -> dict[str, str]:
    return {key: sql(final) for key, final in FINAL.items()}
