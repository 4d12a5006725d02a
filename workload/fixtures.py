"""The driver's tables seen as subscription data.

Each view is a list of (column, expression) pairs whose text is valid in Spark SQL and in DuckDB, so
the query and its SQL counterpart start from the same rows.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subledger.operators.merge import union_all
from subledger.plans.lifecycle import subscription_view
from subledger.schemas import COUNTERS_SCHEMA, FACTS, TX_SCHEMA
from subledger.session import scratch_path
from subledger.sources.csv import list_children
from subledger.sources.dims import complete_dim
from subledger.sources.tables import read_facts, save_fact

AS_OF = "2024-01-31"
LONG_AS_OF = "2001-11-05"

_KIND = (
    "CASE event_type WHEN 'signup' THEN 'ACT' WHEN 'purchase' THEN 'RENO' WHEN 'view' THEN 'DCT' "
    "WHEN 'error' THEN 'RFND' WHEN 'click' THEN CASE WHEN event_id % 2 = 0 THEN 'CNR' ELSE 'PPD' END END"
)
_CODE = "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)"
_CHARGED = "event_type IN ('signup', 'purchase') OR (event_type = 'click' AND event_id % 2 = 1)"
_PHONED = "event_type <> 'error' AND NOT (event_type = 'click' AND event_id % 2 = 0)"
_DAY = "CAST(CAST(ts AS DATE) AS TIMESTAMP)"

# One month of all six types, from ``events``. Some ids, phones, users and codes are null.
TX = {
    "tx_type": _KIND,
    "subscription_id": "CASE WHEN event_id % 97 <> 0 THEN user_id * 10 + event_id % 4 END",
    "tmuserid": "CASE WHEN event_id % 79 <> 0 THEN 'U' || CAST(user_id AS STRING) END",
    "msisdn": f"CASE WHEN event_id % 89 <> 0 AND {_PHONED} THEN 'M' || CAST(user_id % 100 AS STRING) END",
    "cpc": f"CASE WHEN event_id % 83 <> 0 THEN {_CODE} END",
    "trans_type_id": "CAST(CASE event_type WHEN 'signup' THEN 1 WHEN 'purchase' THEN 2 WHEN 'view' THEN 3 "
                     "WHEN 'click' THEN CASE WHEN event_id % 2 = 1 THEN 4 END END AS BIGINT)",
    "channel_id": "event_id % 6",
    "channel": "CASE WHEN event_type = 'error' OR (event_type = 'click' AND event_id % 2 = 1) THEN NULL "
               "WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 7 = 0 THEN 'UPGRADE' "
               "WHEN event_id % 3 = 0 THEN 'WEB' ELSE 'APP' END",
    "trans_date": "ts",
    "act_date": f"CASE WHEN {_PHONED} THEN {_DAY} END",
    "reno_date": f"CASE WHEN {_PHONED} AND event_id % 3 = 0 THEN ts END",
    "camp_name": f"CASE WHEN {_PHONED} AND event_id % 4 <> 0 THEN 'C' || CAST({_CODE} % 8 AS STRING) END",
    "rev": f"CASE WHEN {_CHARGED} THEN CASE WHEN event_id % 5 = 0 THEN CAST(0 AS DOUBLE) ELSE value END END",
    "rfnd_amount": "CASE WHEN event_type = 'error' THEN value END",
    "rfnd_cnt": "CASE WHEN event_type = 'error' THEN 1 + event_id % 3 END",
    "instant_rfnd": "CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 2 = 0 THEN 't' ELSE 'f' END END",
    "year_month": "substr(CAST(CAST(ts AS DATE) AS STRING), 1, 7)",
    "tie": "event_id",
}

# Eighty months: activations, renewals and deactivations from ``orders``, the other types from ``lineitem``.
TX_LONG_ORDERS = {
    "tx_type": "CASE o_orderstatus WHEN 'F' THEN 'ACT' WHEN 'O' THEN 'RENO' ELSE 'DCT' END",
    "subscription_id": "o_custkey",
    "tmuserid": "'U' || CAST(o_custkey % 700 AS STRING)",
    "msisdn": "'M' || CAST(o_custkey % 500 AS STRING)",
    "cpc": "o_orderkey % 100",
    "trans_type_id": "CAST(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS BIGINT)",
    "channel_id": "CAST(NULL AS BIGINT)",
    "channel": "o_orderpriority",
    "trans_date": "o_orderdate",
    "act_date": "o_orderdate",
    "reno_date": "CAST(NULL AS TIMESTAMP)",
    "camp_name": "o_orderpriority",
    "rev": "CASE WHEN o_orderstatus IN ('F', 'O') THEN o_totalprice END",
    "rfnd_amount": "CAST(NULL AS DOUBLE)",
    "rfnd_cnt": "CAST(NULL AS BIGINT)",
    "instant_rfnd": "CAST(NULL AS STRING)",
    "year_month": "substr(CAST(CAST(o_orderdate AS DATE) AS STRING), 1, 7)",
    "tie": "o_orderkey",
}
TX_LONG_LINES = {
    "tx_type": "CASE l_returnflag WHEN 'R' THEN 'RFND' WHEN 'A' THEN 'CNR' ELSE 'PPD' END",
    "subscription_id": "l_partkey",
    "tmuserid": "'U' || CAST(l_partkey % 700 AS STRING)",
    "msisdn": "CASE WHEN l_returnflag = 'N' THEN 'M' || CAST(l_partkey % 500 AS STRING) END",
    "cpc": "l_orderkey % 100",
    "trans_type_id": "CAST(CASE WHEN l_returnflag = 'N' THEN 4 END AS BIGINT)",
    "channel_id": "CAST(NULL AS BIGINT)",
    "channel": "CASE WHEN l_returnflag = 'A' THEN l_linestatus END",
    "trans_date": "l_shipdate",
    "act_date": "CAST(NULL AS TIMESTAMP)",
    "reno_date": "CAST(NULL AS TIMESTAMP)",
    "camp_name": "CAST(NULL AS STRING)",
    "rev": "CASE WHEN l_returnflag = 'N' THEN l_extendedprice END",
    "rfnd_amount": "CASE WHEN l_returnflag = 'R' THEN l_extendedprice END",
    "rfnd_cnt": "CASE WHEN l_returnflag = 'R' THEN l_linenumber END",
    "instant_rfnd": "CASE WHEN l_returnflag = 'R' THEN CASE WHEN l_linestatus = 'F' THEN 't' ELSE 'f' END END",
    "year_month": "substr(CAST(CAST(l_shipdate AS DATE) AS STRING), 1, 7)",
    "tie": "((l_orderkey * 8 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey",
}

# Every part is a product; codes 0 to 9 of the transactions have none.
DIM = {
    "cpc": "p_partkey + 10",
    "service_name": "p_brand",
    "tme_category": "CASE WHEN p_partkey % 13 <> 0 THEN p_type END",
    "cpc_period": "p_size",
    "cpc_price": "CASE WHEN p_partkey % 17 <> 0 THEN p_retailprice END",
}
DIM_EXCLUDED = ("brand#1",)
CATEGORY_GROUPS = {"economy": "Eco_Promo", "promo": "Eco_Promo", "small": "Small_Med", "medium": "Small_Med"}

# Phones of suppliers in debt, users of customers deep in debt.
EXCLUDED_PHONES = ("supplier", "'M' || CAST(s_suppkey AS STRING)", "s_acctbal < 0")
EXCLUDED_USERS = ("customer", "'U' || CAST(c_custkey AS STRING)", "c_acctbal < -900")

# User-base snapshots, from ``orders`` joined to their product.
SNAPSHOT = {
    "date": "CAST(o_orderdate AS DATE)",
    "service_name": "' ' || p_brand",
    "tme_category": "p_type || ' '",
    "cpc": "p_partkey + 10",
    "count": "CAST(o_orderkey % 50 AS STRING) || '.7'",
}
SNAPSHOT_JOIN = "o_custkey = p_partkey"

# The operational tables: the subscription fact, the channels, cancellations and refunds.
SOURCE_FACT = {
    "msisdn": "'U' || CAST(user_id AS STRING)",
    "generic_act_info": f"'chrg_refid=M' || CAST(user_id % 100 AS STRING) || CASE WHEN event_id % 13 = 0 THEN '' ELSE "
                        f"';cpc=' || CAST({_CODE} AS STRING) END || ';campaign=C' || CAST({_CODE} % 8 AS STRING) || "
                        f"';TEFProvider=' || CAST({_CODE} % 5 AS STRING) || ';TEFmedium=web;'",
    "trans_type_id": "CASE event_type WHEN 'signup' THEN 1 WHEN 'purchase' THEN 2 WHEN 'view' THEN 3 "
                     "WHEN 'click' THEN 4 ELSE 5 END",
    "channel_id": "event_id % 6",
    "tlog_ts": "ts",
    "request_ts": _DAY,
    "next_charging_date": "CASE WHEN event_id % 3 = 0 THEN ts END",
    "subscription_id": "user_id * 10 + event_id % 4",
    "charged_amount": "value",
}
SOURCE_CHANNELS = {"channel_id": "r_regionkey", "channel_desc": "r_name"}
SOURCE_CANCELLATIONS = {
    "timestamp": "ts", "sbn_id": "CAST(user_id * 10 + event_id % 4 AS STRING)",
    "msisdn": "'U' || CAST(user_id AS STRING)", "cpc": _CODE, "mode": "event_type",
}
SOURCE_REFUNDS = {
    "msisdn": "'U' || CAST(user_id AS STRING)", "cpc": f"{_CODE} % 10", "timestamp": "ts", "amount": "value",
    "info": "'sbnId=' || CAST(user_id * 10 + event_id % 4 AS STRING) || ',' || "
            "CASE WHEN event_id % 2 = 0 THEN 'AUTOMATIC refund' ELSE 'Manual' END",
}

# The cells of a daily activation extract as text, with every null token and some that do not parse.
CSV_ACT = {
    "tmuserid": "'U' || CAST(user_id AS STRING)",
    "msisdn": "CASE WHEN event_id % 7 = 0 THEN 'NULL' WHEN event_id % 7 = 1 THEN '' ELSE 'M' || CAST(user_id % 100 AS STRING) END",
    "cpc": f"CASE WHEN event_id % 10 = 0 THEN 'abc' WHEN event_id % 10 = 1 THEN 'null' ELSE CAST({_CODE} AS STRING) END",
    "trans_type_id": "'1'",
    "channel_id": "CAST(event_id % 6 AS STRING)",
    "channel_act": "CASE WHEN event_id % 5 = 0 THEN 'A, 0,99 \"x\"' ELSE 'WEB' END",
    "trans_date": "CASE WHEN event_id % 9 = 0 THEN CAST(CAST(ts AS DATE) AS STRING) WHEN event_id % 9 = 1 THEN CAST(CAST(ts AS DATE) AS STRING) || ' 10:00:00.123' "
                  "WHEN event_id % 9 = 2 THEN 'x' ELSE CAST(CAST(ts AS DATE) AS STRING) || substr(CAST(ts AS STRING), 11, 9) END",
    "act_date": "CAST(CAST(ts AS DATE) AS STRING)",
    "reno_date": "''",
    "camp_name": f"'C' || CAST({_CODE} % 8 AS STRING)",
    "tef_prov": "CAST(event_id % 4 AS STRING)",
    "campana_medium": "'NULL'",
    "campana_id": "'null'",
    "subscription_id": "CAST(user_id * 10 + event_id % 4 AS STRING)",
    "rev": "CASE WHEN event_id % 8 = 0 THEN 'n/a' ELSE CAST(value AS STRING) END",
}


def select_text(columns: dict[str, str]) -> str:
    """The view's select list as SQL."""
    return ", ".join(f"{expr} AS {name}" for name, expr in columns.items())


def view(rows: DataFrame, columns: dict[str, str], schema=None) -> DataFrame:
    """The view's columns over Spark rows, cast to a schema where one is given."""
    kinds = {} if schema is None else {f.name: f.dataType.simpleString() for f in schema.fields}
    return rows.selectExpr(*[
        f"CAST({expr} AS {kinds[name]}) AS {name}" if name in kinds else f"{expr} AS {name}" for name, expr in columns.items()
    ])


_WRITTEN: dict[tuple[str, str, str], str] = {}


class Data:
    """The views over one folder of driver tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def tx(self) -> DataFrame:
        return view(self.table("events"), TX, TX_SCHEMA)

    def tx_long(self) -> DataFrame:
        return union_all([
            view(self.table("orders"), TX_LONG_ORDERS, TX_SCHEMA),
            view(self.table("lineitem"), TX_LONG_LINES, TX_SCHEMA),
        ])

    def raw_dim(self) -> DataFrame:
        return view(self.table("part"), DIM).selectExpr(
            "CAST(cpc AS BIGINT) cpc", "service_name", "tme_category", "CAST(cpc_period AS BIGINT) cpc_period",
            "CAST(cpc_price AS DOUBLE) cpc_price",
        )

    def dim(self) -> DataFrame:
        return complete_dim(self.raw_dim())

    def subs(self) -> DataFrame:
        return subscription_view(self.tx(), AS_OF)

    def subs_long(self) -> DataFrame:
        return subscription_view(self.tx_long(), LONG_AS_OF)

    def listed(self, spec: tuple[str, str, str]) -> DataFrame:
        table, expr, condition = spec
        return self.table(table).where(condition).selectExpr(f"{expr} AS id")

    def snapshots(self) -> DataFrame:
        joined = self.table("orders").join(self.table("part"), F.expr(SNAPSHOT_JOIN))
        return view(joined, SNAPSHOT)

    def source_fact(self) -> DataFrame:
        rows = view(self.table("events"), SOURCE_FACT)
        return rows.withColumn("request_ts", F.col("request_ts").cast("timestamp_ntz"))

    def channels(self) -> DataFrame:
        return view(self.table("region"), SOURCE_CHANNELS)

    def source_cancellations(self) -> DataFrame:
        return view(self.table("events").where("event_type = 'click'"), SOURCE_CANCELLATIONS)

    def source_refunds(self) -> DataFrame:
        return view(self.table("events").where("event_type = 'error'"), SOURCE_REFUNDS)

    def raw_fact(self, kind: str, tx: DataFrame, *extra: Column) -> DataFrame:
        """One type of a transaction view, back under the type's own column names, and ``extra`` columns of the view."""
        fact = FACTS[kind]
        names = {fact.event_date: "trans_date", fact.subscription: "subscription_id"}
        if fact.channel:
            names[fact.channel] = "channel"
        rows = tx.where(F.col("tx_type") == fact.tag)
        picked = []
        for field in fact.stored_schema.fields:
            source = names.get(field.name, field.name)
            value = F.col(source) if source in tx.columns else F.lit(None)
            picked.append(value.cast(field.dataType).alias(field.name))
        return rows.select(*picked, *extra)

    def store(self) -> dict[str, DataFrame]:
        """The six types of the long view written as month-partitioned tables, and read back."""
        return read_facts(self.spark, self.store_root())

    def store_root(self) -> str:
        return self.written("facts", self._write_store)

    def csv_folder(self) -> str:
        return self.written("extract", self._write_csv)

    def written(self, label: str, write) -> str:
        """Path of something written once per application and folder."""
        key = (self.spark.sparkContext.applicationId, self.folder, label)
        if key not in _WRITTEN:
            path = scratch_path(self.spark, label)
            write(path)
            _WRITTEN[key] = path
        return _WRITTEN[key]

    def _write_store(self, root: str) -> None:
        tx = self.tx_long()
        # Six independent jobs, run side by side.
        with ThreadPoolExecutor(len(FACTS)) as pool:
            list(pool.map(lambda f: save_fact(self.raw_fact(f.name, tx), root, f, partitions=("year_month",)), FACTS.values()))

    def named_files(self, label: str, rows: DataFrame, name: Column, **options: str) -> str:
        """Rows written as CSV files under names of their own; one or more files share a name's start."""
        def write(path: str) -> None:
            parts = rows.withColumn("file_name", name)
            parts.hint("rebalance", "file_name").write.partitionBy("file_name").options(header=True, escape='"', **options).csv(f"{path}-parts")
            files = self.spark._jvm.org.apache.hadoop.fs
            system = files.Path(path).getFileSystem(self.spark._jsc.hadoopConfiguration())
            system.mkdirs(files.Path(path))
            for k, part in enumerate(list_children(self.spark, f"{path}-parts/file_name=*/*.csv")):
                start = part.rpartition("/")[0].rpartition("file_name=")[2]
                system.rename(files.Path(part), files.Path(f"{path}/{start}_{k:04d}.csv"))

        return self.written(label, write)

    def copy_files(self, files: list[str], path: str) -> None:
        """Copies of some files in a folder of their own."""
        hadoop = self.spark._jvm.org.apache.hadoop
        conf = self.spark._jsc.hadoopConfiguration()
        target = hadoop.fs.Path(path)
        system = target.getFileSystem(conf)
        system.mkdirs(target)
        for file in files:
            hadoop.fs.FileUtil.copy(system, hadoop.fs.Path(file), system, target, False, conf)

    def _write_csv(self, path: str) -> None:
        rows = view(self.table("events").where("event_type = 'signup'"), CSV_ACT)
        rows.write.option("header", True).option("escape", '"').csv(path)

    def no_counters(self) -> DataFrame:
        return self.spark.createDataFrame([], COUNTERS_SCHEMA)
