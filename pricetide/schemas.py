"""Explicit schemas for every boundary; nothing is inferred."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
    VarcharType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, dtype) for name, dtype in fields.items()])


# --- fixed values: field names of the landed JSON documents -----------------

LANDED_DEAL_NAMES = {
    "steamAppID": "item_id",
    "storeID": "store_id",
    "salePrice": "sale_price",
    "normalPrice": "list_price",
    "savings": "discount",
    "steamRatingText": "rating_label",
    "steamRatingPercent": "rating_pct",
}
LANDED_STORE_NAMES = {"storeID": "store_id", "storeName": "store_name"}
LANDED_RECORD_NAMES = {
    "steam_app_id": "item_id",
    "nome": "name",
    "preco_steam": "price",
    "preco_oferta": "sale_price",
    "preco_normal": "list_price",
    "desconto": "discount",
    "avaliacao": "rating_label",
    "avaliacao_percentual": "rating_pct",
    "loja": "store",
    "generos": "tags",
    "desenvolvedores": "makers",
}

# --- fixed values: labels that appear in results -----------------------------

UNKNOWN_NAME = "DESCONHECIDO"
STORE_LABEL_PREFIX = "Loja "
OFFER_CURRENCY = "USD"
ACCEPTED_CURRENCIES = ("BRL", "USD")
TIERS = (("EXCELENTE", 75), ("BOA", 50), ("MEDIA", 25))
LOWEST_TIER = "BAIXA"
TIER_ORDER = ("EXCELENTE", "BOA", "MEDIA", "BAIXA")
DEFAULT_STORES = (
    ("1", "Steam"),
    ("2", "GamersGate"),
    ("3", "GreenManGaming"),
    ("7", "GOG"),
    ("8", "Origin"),
    ("11", "Humble Store"),
    ("13", "Fanatical"),
    ("15", "Gamesplanet"),
    ("21", "WinGameStore"),
    ("23", "GameBillet"),
    ("24", "Voidu"),
    ("25", "Epic Games Store"),
    ("27", "Games Republic"),
    ("28", "Gamesload"),
    ("29", "2Game"),
)

# --- landed documents ---------------------------------------------------------

PRICE = _struct(
    currency=StringType(), initial=LongType(), final=LongType(), discount_percent=LongType()
)
TAG = _struct(id=StringType(), description=StringType())

LANDED_DEAL = StructType([StructField(n, StringType()) for n in LANDED_DEAL_NAMES])
LANDED_STORE = StructType([StructField(n, StringType()) for n in LANDED_STORE_NAMES])
LANDED_DETAIL_MAP = MapType(
    StringType(),
    _struct(
        success=BooleanType(),
        data=_struct(
            name=StringType(),
            price_overview=PRICE,
            genres=ArrayType(TAG),
            developers=ArrayType(StringType()),
        ),
    ),
)
LANDED_RECORD = StructType(
    [
        StructField(
            name,
            {"price": PRICE, "tags": ArrayType(TAG), "makers": ArrayType(StringType())}.get(
                neutral, StringType()
            ),
        )
        for name, neutral in LANDED_RECORD_NAMES.items()
    ]
)
LANDED_METADATA = _struct(
    camada=StringType(),
    pipeline_version=StringType(),
    execution_id=StringType(),
    ambiente=StringType(),
    data_ingestao=StringType(),
    timestamp_ingestao=StringType(),
    fontes=ArrayType(StringType()),
    total_ofertas_recebidas=LongType(),
    total_jogos_processados=LongType(),
    total_registros=LongType(),
)
LANDED_ENVELOPE = _struct(metadata=LANDED_METADATA, dados=ArrayType(LANDED_RECORD))

# --- lake tables; the snapshot date is the partition key -----------------------

_TEXT_DEAL = dict(
    sale_price=StringType(),
    list_price=StringType(),
    discount=StringType(),
    rating_label=StringType(),
    rating_pct=StringType(),
)
_LINEAGE = dict(
    layer=StringType(),
    version=StringType(),
    run_id=StringType(),
    environment=StringType(),
    sources=ArrayType(StringType()),
    ingested_at=TimestampType(),
)
_DATED = dict(processed_at=TimestampType(), snapshot_date=DateType())

BRONZE_RECORDS = _struct(
    item_id=StringType(),
    name=StringType(),
    price=PRICE,
    **_TEXT_DEAL,
    store=StringType(),
    tags=ArrayType(TAG),
    makers=ArrayType(StringType()),
    **_LINEAGE,
    snapshot_date=DateType(),
)
BRONZE_MANIFEST = _struct(
    n_offers_received=LongType(),
    n_unreadable=LongType(),
    n_missing_key=LongType(),
    n_duplicate=LongType(),
    n_lookup_failed=LongType(),
    n_items_processed=LongType(),
    n_records=LongType(),
    **_LINEAGE,
    snapshot_date=DateType(),
)
QUARANTINE = _struct(
    source=StringType(), file=StringType(), text=StringType(), **_LINEAGE, snapshot_date=DateType()
)
LEDGER = _struct(
    source=StringType(),
    path=StringType(),
    size=LongType(),
    modified=TimestampType(),
    **_LINEAGE,
    snapshot_date=DateType(),
)
_ITEM_PRICES = dict(
    item_id=StringType(),
    name=StringType(),
    sale_price=DoubleType(),
    list_price=DoubleType(),
)
_ITEM_RATING = dict(
    offer_currency=StringType(),
    discount_pct=DoubleType(),
    rating_label=StringType(),
    rating_pct=IntegerType(),
    store=StringType(),
    ref_price=DoubleType(),
    ref_list_price=DoubleType(),
    ref_currency=StringType(),
)
SILVER_ITEMS = _struct(
    **_ITEM_PRICES, **_ITEM_RATING, ref_discount_pct=DoubleType(), **_DATED
)
SILVER_TAGS = _struct(item_id=StringType(), tag_id=IntegerType(), tag_name=StringType(), **_DATED)
SILVER_MAKERS = _struct(item_id=StringType(), maker_name=StringType(), **_DATED)

_MEASURES = dict(
    n_items=LongType(),
    avg_discount=DoubleType(),
    avg_sale_price=DoubleType(),
    avg_list_price=DoubleType(),
    max_discount=DoubleType(),
    avg_rating=DoubleType(),
    snapshot_date=DateType(),
)
GOLD_TABLES = {
    "price_history": _struct(
        **_ITEM_PRICES,
        ref_price=DoubleType(),
        ref_currency=StringType(),
        discount_pct=DoubleType(),
        snapshot_date=DateType(),
    ),
    "offers": _struct(
        **_ITEM_PRICES,
        **_ITEM_RATING,
        savings=DoubleType(),
        deal_tier=StringType(),
        snapshot_date=DateType(),
    ),
    "rank_makers": _struct(maker_name=StringType(), **_MEASURES),
    "rank_tags": _struct(tag_id=IntegerType(), tag_name=StringType(), **_MEASURES),
}

# --- serving tables: fixed types, lengths and keys ----------------------------

MONEY = DecimalType(10, 2)
PERCENT = DecimalType(5, 2)

SERVING_PRICE_HISTORY = _struct(
    item_id=IntegerType(),
    name=VarcharType(255),
    sale_price=MONEY,
    list_price=MONEY,
    ref_price=MONEY,
    ref_currency=VarcharType(10),
    discount_pct=PERCENT,
    snapshot_date=DateType(),
)
SERVING_OFFERS = _struct(
    item_id=IntegerType(),
    name=VarcharType(255),
    sale_price=MONEY,
    list_price=MONEY,
    offer_currency=VarcharType(10),
    discount_pct=PERCENT,
    rating_label=VarcharType(100),
    rating_pct=IntegerType(),
    store=VarcharType(100),
    ref_price=MONEY,
    ref_list_price=MONEY,
    ref_currency=VarcharType(10),
    savings=MONEY,
    deal_tier=VarcharType(50),
    snapshot_date=DateType(),
)
_RANK_MEASURES = dict(
    n_items=IntegerType(),
    avg_discount=PERCENT,
    avg_sale_price=MONEY,
    avg_list_price=MONEY,
    max_discount=PERCENT,
    avg_rating=DecimalType(5, 1),
    snapshot_date=DateType(),
)
SERVING_RANK_MAKERS = _struct(maker_name=VarcharType(255), **_RANK_MEASURES)
SERVING_RANK_TAGS = _struct(
    tag_id=IntegerType(), tag_name=VarcharType(255), **_RANK_MEASURES
)

SERVING_TABLES = {
    "price_history": SERVING_PRICE_HISTORY,
    "offers": SERVING_OFFERS,
    "rank_makers": SERVING_RANK_MAKERS,
    "rank_tags": SERVING_RANK_TAGS,
}
UNIQUE_KEYS = {"price_history": ("item_id", "snapshot_date")}
