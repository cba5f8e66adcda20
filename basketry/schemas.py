"""Column names and types of every table the package reads or writes."""

from pyspark.sql import types as T

DATE, TEXT, INT, LONG = T.DateType(), T.StringType(), T.IntegerType(), T.LongType()
FLAG, SHORT = T.BooleanType(), T.ShortType()
PRICE = T.DecimalType(10, 2)
UNITS = T.DecimalType(12, 5)


def _table(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


STORES = _table(store_nbr=INT, city=TEXT, state=TEXT, type=TEXT, cluster=INT)
ITEMS = T.StructType(
    [
        T.StructField("item_nbr", INT),
        T.StructField("family", TEXT),
        T.StructField("class", INT),
        T.StructField("perishable", SHORT),
    ]
)
TRANSACTIONS = _table(date=DATE, store_nbr=INT, transactions=INT)
OIL = _table(date=DATE, dcoilwtico=PRICE)
HOLIDAYS_EVENTS = _table(
    date=DATE, type=TEXT, locale=TEXT, locale_name=TEXT, description=TEXT, transferred=FLAG
)
TRAIN = _table(
    id=LONG, date=DATE, store_nbr=INT, item_nbr=INT, unit_sales=UNITS, onpromotion=FLAG
)
TEST = _table(id=LONG, date=DATE, store_nbr=INT, item_nbr=INT, onpromotion=FLAG)

TABLES = {
    "stores": STORES,
    "items": ITEMS,
    "transactions": TRANSACTIONS,
    "oil": OIL,
    "holidays_events": HOLIDAYS_EVENTS,
    "train": TRAIN,
    "test": TEST,
}

#: Tables whose rows are counted after a load; ``test`` is optional.
LOADED_TABLES = ("stores", "items", "transactions", "oil", "holidays_events", "train")

PRIMARY_KEYS = {
    "stores": ("store_nbr",),
    "items": ("item_nbr",),
    "transactions": ("date", "store_nbr"),
    "oil": ("date",),
    "train": ("id", "date"),
}

#: (child table, parent table, shared key column)
FOREIGN_KEYS = (
    ("transactions", "stores", "store_nbr"),
    ("train", "stores", "store_nbr"),
    ("train", "items", "item_nbr"),
)

REQUIRED_COLUMNS = {
    "stores": ("store_nbr", "city", "state", "type", "cluster"),
    "items": ("item_nbr", "family", "class", "perishable"),
    "transactions": ("date", "store_nbr", "transactions"),
    "oil": ("date",),
    "holidays_events": ("date", "type", "locale"),
    "train": ("id", "date", "store_nbr", "item_nbr", "unit_sales"),
}

#: Values for columns a source file may leave out altogether.
COLUMN_DEFAULTS = {"holidays_events": {"transferred": False}}

MASTER = _table(
    id=LONG,
    date=DATE,
    store_nbr=INT,
    item_nbr=INT,
    unit_sales=UNITS,
    onpromotion=FLAG,
    city=TEXT,
    state=TEXT,
    store_type=TEXT,
    store_cluster=INT,
    item_family=TEXT,
    item_class=INT,
    perishable=SHORT,
    oil_price=PRICE,
    oil_is_imputed=FLAG,
    is_holiday=FLAG,
    holiday_type=TEXT,
    holiday_description=TEXT,
    year=INT,
    month=INT,
    week_of_year=INT,
    day_of_month=INT,
    day_of_week=INT,
    is_weekend=FLAG,
    is_payday=FLAG,
    is_month_start=FLAG,
    is_month_end=FLAG,
)
