"""Synthetic text columns, chosen by field name.

A value depends only on the seed, the row id and the field, so any executor produces the
same row again, and rows are independent of the number of partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_SCHEMA = "name string, date string, zipcode string, state string"
DEFAULT_ROWS = 3

# The word lists values are drawn from.
WORDS: dict[str, tuple[str, ...]] = {
    "first_name": (
        "Ada", "Amir", "Bela", "Chen", "Dora", "Emil", "Fatou", "Goran", "Hana", "Ines", "Jonas", "Kofi",
        "Lena", "Mateo", "Nadia", "Omar", "Petra", "Quinn", "Rosa", "Sven", "Tara", "Uma", "Viktor", "Wanda",
    ),
    "last_name": (
        "Abara", "Berg", "Castro", "Dahl", "Eriksen", "Fischer", "Garcia", "Haddad", "Ito", "Jansen", "Kim",
        "Lopez", "Moreau", "Novak", "Okafor", "Petrov", "Rossi", "Santos", "Tanaka", "Weber",
    ),
    "state": (
        "Alabama", "Alaska", "Arizona", "Arkansas", "California", "Colorado", "Connecticut", "Delaware", "Florida",
        "Georgia", "Hawaii", "Idaho", "Illinois", "Indiana", "Iowa", "Kansas", "Kentucky", "Louisiana", "Maine",
        "Maryland", "Massachusetts", "Michigan", "Minnesota", "Mississippi", "Missouri", "Montana", "Nebraska",
        "Nevada", "New Hampshire", "New Jersey", "New Mexico", "New York", "North Carolina", "North Dakota", "Ohio",
        "Oklahoma", "Oregon", "Pennsylvania", "Rhode Island", "South Carolina", "South Dakota", "Tennessee", "Texas",
        "Utah", "Vermont", "Virginia", "Washington", "West Virginia", "Wisconsin", "Wyoming",
    ),
    "city": (
        "Ashford", "Brookside", "Clearwater", "Dunmore", "Eastport", "Fairview", "Greenfield", "Harborview",
        "Irongate", "Kingsbury", "Lakeside", "Milltown", "Northfield", "Oakdale", "Riverton", "Stonebridge",
    ),
    "country": (
        "Argentina", "Australia", "Brazil", "Canada", "Chile", "Denmark", "Egypt", "Finland", "France", "Germany",
        "Ghana", "India", "Italy", "Japan", "Kenya", "Mexico", "Norway", "Poland", "Portugal", "Spain",
    ),
    "street_suffix": ("Avenue", "Court", "Drive", "Lane", "Road", "Square", "Street", "Way"),
    "company_suffix": ("and Sons", "Group", "Inc", "LLC", "Ltd", "PLC"),
    "job": (
        "Accountant", "Architect", "Baker", "Carpenter", "Chemist", "Designer", "Editor", "Electrician", "Engineer",
        "Geologist", "Librarian", "Nurse", "Pilot", "Surveyor", "Teacher", "Translator",
    ),
    "color_name": ("Amber", "Azure", "Coral", "Crimson", "Indigo", "Ivory", "Olive", "Teal", "Violet", "White"),
    "currency_code": ("AUD", "BRL", "CAD", "CHF", "EUR", "GBP", "INR", "JPY", "MXN", "USD"),
    "domain": ("example.com", "example.net", "example.org"),
    "month_name": (
        "January", "February", "March", "April", "May", "June", "July", "August", "September", "October",
        "November", "December",
    ),
    "day_of_week": ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"),
    "word": (
        "anchor", "bridge", "canal", "depot", "engine", "ferry", "gauge", "harbor", "island", "jetty", "keel",
        "lantern", "mast", "needle", "orbit", "pier", "quay", "rudder", "signal", "tide",
    ),
}
FIRST_DAY = "1970-01-01"
DAY_SPAN = 20_000


class _Row:
    """Draws for one row: every use names its own stream, so draws are independent."""

    def __init__(self, seed: int, row_id: Column) -> None:
        self.seed = seed
        self.row_id = row_id

    def number(self, stream: str, bound: int) -> Column:
        digest = F.md5(F.concat_ws(":", F.lit(str(self.seed)), F.lit(stream), self.row_id.cast("string")))
        return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % bound).cast("int")

    def word(self, stream: str, words: str | None = None) -> Column:
        options = WORDS[words or stream]
        return F.element_at(F.array(*[F.lit(w) for w in options]), self.number(stream, len(options)) + 1)

    def digits(self, stream: str, count: int) -> Column:
        return F.lpad(self.number(stream, 10**count).cast("string"), count, "0")


def _day(row: _Row) -> Column:
    return F.date_add(F.lit(FIRST_DAY).cast("date"), row.number("date", DAY_SPAN))


def _name(row: _Row) -> Column:
    return F.concat_ws(" ", row.word("first_name"), row.word("last_name"))


def _user(row: _Row) -> Column:
    return F.concat(F.lower(row.word("first_name")), F.lit("."), F.lower(row.word("last_name")))


def _street(row: _Row) -> Column:
    number = (row.number("building_number", 998) + 1).cast("string")
    return F.concat_ws(" ", number, row.word("street_name", "last_name"), row.word("street_suffix"))


def _company(row: _Row) -> Column:
    return F.concat_ws(" ", row.word("company", "last_name"), row.word("company_suffix"))


def _email(row: _Row) -> Column:
    return F.concat(_user(row), F.lit("@"), row.word("domain"))


def _phone(row: _Row) -> Column:
    return F.concat(F.lit("555-"), row.digits("exchange", 3), F.lit("-"), row.digits("line", 4))


def _address(row: _Row) -> Column:
    place = F.concat_ws(" ", row.word("state"), row.digits("zipcode", 5))
    return F.concat_ws(", ", _street(row), row.word("city"), place)


def _ipv4(row: _Row) -> Column:
    return F.concat_ws(".", *[row.number(f"octet{i}", 256).cast("string") for i in range(4)])


def _time(row: _Row) -> Column:
    parts = [("hour", 24), ("minute", 60), ("second", 60)]
    return F.concat_ws(":", *[F.lpad(row.number(n, b).cast("string"), 2, "0") for n, b in parts])


PROVIDERS = {
    "name": _name,
    "first_name": lambda r: r.word("first_name"),
    "last_name": lambda r: r.word("last_name"),
    "user_name": _user,
    "email": _email,
    "phone_number": _phone,
    "company": _company,
    "job": lambda r: r.word("job"),
    "address": _address,
    "street_address": _street,
    "city": lambda r: r.word("city"),
    "state": lambda r: r.word("state"),
    "country": lambda r: r.word("country"),
    "zipcode": lambda r: r.digits("zipcode", 5),
    "postcode": lambda r: r.digits("zipcode", 5),
    "date": lambda r: F.date_format(_day(r), "yyyy-MM-dd"),
    "year": lambda r: F.date_format(_day(r), "yyyy"),
    "time": _time,
    "month_name": lambda r: r.word("month_name"),
    "day_of_week": lambda r: r.word("day_of_week"),
    "color_name": lambda r: r.word("color_name"),
    "currency_code": lambda r: r.word("currency_code"),
    "domain_name": lambda r: r.word("domain"),
    "ipv4": _ipv4,
    "word": lambda r: r.word("word"),
}


def check_fields(schema: T.StructType) -> None:
    for field in schema.fields:
        if field.name not in PROVIDERS:
            raise ValueError(
                f"Unable to find a provider called `{field.name}`; providers are {', '.join(sorted(PROVIDERS))}"
            )
        if not isinstance(field.dataType, T.StringType):
            raise ValueError(f"`{field.name}` must be a string column, as all generated ones are")


def fake_columns(df: DataFrame, row_id: str, schema: T.StructType | str = DEFAULT_SCHEMA, seed: int = 0) -> DataFrame:
    """Add the synthetic columns of ``schema`` to each row, drawn by its id."""
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    check_fields(wanted)
    row = _Row(seed, F.col(row_id))
    return df.select("*", *[PROVIDERS[f.name](row).alias(f.name) for f in wanted.fields])


def generate(
    spark: SparkSession,
    rows: int = DEFAULT_ROWS,
    schema: T.StructType | str = DEFAULT_SCHEMA,
    seed: int = 0,
    partitions: int | None = None,
) -> DataFrame:
    """``rows`` synthetic rows, split evenly over ``partitions``."""
    return fake_columns(spark.range(0, rows, 1, partitions), "id", schema, seed).drop("id")


def generate_stream(
    spark: SparkSession,
    rows_per_batch: int = DEFAULT_ROWS,
    schema: T.StructType | str = DEFAULT_SCHEMA,
    seed: int = 0,
    partitions: int | None = None,
) -> DataFrame:
    """A stream of exactly ``rows_per_batch`` rows per micro-batch; a replay repeats them."""
    reader = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rows_per_batch)
    if partitions is not None:
        reader = reader.option("numPartitions", partitions)
    return fake_columns(reader.load(), "value", schema, seed).drop("timestamp", "value")


def counted_ranges(spark: SparkSession, total: int, partitions: int) -> DataFrame:
    """Ids 0..total-1 in near-equal ranges, with the number of the range each came from."""
    return spark.range(0, total, 1, partitions).withColumn("partition_no", F.spark_partition_id())
