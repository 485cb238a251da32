"""Bike-share views over the generic test tables, as SQL both engines read.

`{S}` is the engine's string type. The other placeholders are table names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

STATIONS = """
select cast(c_custkey as {S}) stationcode, c_name as name,
  cast(ebike+mechanical as int) numbikesavailable,
  cast(case when c_custkey%97=0 then null when c_custkey%19=0 then 0
            else greatest(capacity-ebike-mechanical,0) end as int) numdocksavailable,
  cast(capacity as int) capacity, cast(mechanical as int) mechanical, cast(ebike as int) ebike,
  case when c_custkey%23=0 then 'NON' else 'OUI' end is_installed,
  case when c_custkey%29=0 then 'NON' when c_custkey%31=0 then null else 'OUI' end is_renting,
  'OUI' is_returning, '2024-01-01T00:00:00+00:00' duedate,
  48.80e0+(c_custkey%101)*0.001e0 lat, 2.25e0+(c_custkey%151)*0.001e0 lon,
  case when c_nationkey=24 then null else n_name end arrondissement,
  cast(75100+c_nationkey as {S}) code_insee_commune
from (select *, 10+c_custkey%51 capacity,
        case when c_custkey%17=0 then 0 else (c_custkey*5)%13 end ebike,
        case when c_custkey%17=0 then 0 else (c_custkey*7)%11 end mechanical from {customer}) c
left join {nation} on c_nationkey=n_nationkey
"""

REPORTS = """
select cast(user_id as {S}) stationcode, ts, date_trunc('day', ts) poll_ts,
  cast(cast(floor(value) as int)%13 as int) ebike, cast((user_id*7)%11 as int) mechanical,
  case when event_type='error' then cast(null as int) when event_type='view' then 0
       else cast(event_id%21 as int) end numdocksavailable,
  event_id, event_type, props
from {events}
"""

POINTS = """
select s_suppkey user_id, s_name address,
  48.805e0+(s_suppkey%89)*0.0011e0 ulat, 2.26e0+(s_suppkey%113)*0.0013e0 ulon from {supplier}
"""

# In turn diagonally off the stations, 1,000 km north of them, and near 0/0.
FAR_POINTS = """
select s_suppkey user_id, s_name address,
  case s_suppkey%3 when 0 then 49.20e0 when 1 then 57.80e0 else 0.00e0 end + (s_suppkey%89)*0.0011e0 ulat,
  case s_suppkey%3 when 0 then 2.80e0 when 1 then 2.26e0 else 0.01e0 end + (s_suppkey%113)*0.0013e0 ulon from {supplier}
"""

CODE_LOOKUP = """
select cast(c_custkey as {S}) stationcode, upper(c_name) name_custom
from {customer} where c_custkey%2=0
"""

ALL_CODES = """
select cast(c_custkey as {S}) stationcode, upper(c_name) name_custom from {customer}
"""

DEPARTMENT_LOOKUP = """
select c_name as name, c_mktsegment department from {customer} where c_custkey%3=0
"""

GAZETTEER = """
select concat('  ', upper(s_name), ' ') address,
  48.805e0+(s_suppkey%89)*0.0011e0 lat, 2.26e0+(s_suppkey%113)*0.0013e0 lon
from {supplier} where s_suppkey%4<>0
"""

TABLES = ("customer", "nation", "events", "supplier")


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a stream.

    A stream source takes a folder or a pattern; the pattern here matches the
    table whether it is one file or a folder of files.
    """
    path = table_path(sf_dir, name)
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).parquet(f"{path[:-1]}[{path[-1]}]")


def view(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """A view of this module over the given tables, batch or streaming."""
    return spark.sql(sql.replace("{S}", "string"), **tables)


def duckdb(sql: str) -> str:
    """The same view as DuckDB text over registered tables of the same name."""
    return sql.replace("{S}", "varchar").format(**{t: t for t in TABLES})
