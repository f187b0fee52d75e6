"""Player-roster CSV sources and sinks.

``read_roster_csv`` reads one roster file set. With ``infer_schema=True``
(what the original batch job does) Spark makes an extra pass over the data
to guess types; at scale prefer the default ``False``: every column is read
as text in a single pass and ``clean_roster`` parses the numbers itself,
which also survives files whose inferred types disagree.

``write_roster_csvs`` builds the two test CSVs (men, women) from the driver
tables ``customer`` and ``supplier`` (FIXTURES.md §6) with a Spark write, so
the read side is exercised on real CSV files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.session import shared_dir

# Fixed values of the test-data adapter: position code by key % 17
# ("XX" belongs to no position group).
ADAPTER_POSITIONS = ["GK", "CB", "RB", "LB", "RWB", "LWB", "CDM", "CM", "CAM",
                     "RM", "LM", "ST", "CF", "LW", "RW", "SS", "XX"]


def read_roster_csv(spark: SparkSession, path: str, infer_schema: bool = False,
                    mode: str = "PERMISSIVE") -> DataFrame:
    """Header CSV -> DataFrame. Read errors (missing path, bad options)
    raise to the caller instead of being printed and swallowed."""
    return (spark.read.option("header", True).option("inferSchema", infer_schema)
            .option("mode", mode).csv(path))


CORRUPT = "_linea_mala"


def read_roster_checked(spark: SparkSession, path: str, columns: list[str], header: bool = True) -> tuple[DataFrame, DataFrame]:
    """(rows, bad lines) of roster CSV files whose columns are known. A line
    that has not as many cells as there are columns is no row: it is kept as
    written, with the id it starts with and the reason, instead of being filled
    up with nulls or cut. Cells stay text; ``clean_roster`` judges them."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, CORRUPT]])
    read = (spark.read.schema(schema).option("header", header).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("columnPruning", False)  # else cells that a query leaves out are not counted
            .csv(path))
    line = F.col(CORRUPT)
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"')))
    cells = F.size(F.split(line, ',(?=(?:[^"]*"[^"]*")*[^"]*$)'))
    reason = (F.when(quotes % 2 == 1, "comillas_abiertas").when(cells < len(columns), "faltan_celdas")
              .when(cells > len(columns), "sobran_celdas").otherwise("ilegible"))
    # true of every row; Spark refuses to read the line column alone, as counting would
    other = F.coalesce(F.col(columns[0]), F.lit("")) >= ""
    good = read.filter(line.isNull() & other).drop(CORRUPT)
    bad = read.filter(line.isNotNull() & other).select(F.col(columns[0]).alias("id"), line.alias("linea"), reason.alias("motivo"))
    return good, bad


def _stats(k):
    def pick(m):
        return F.lit(40) + k * m % 60
    return {
        "PAC": F.when(k % 50 == 3, F.lit(None).cast("bigint")).otherwise(pick(7)),
        "PAS": pick(11),
        "SHO": pick(13),
        "PHY": F.when(k % 70 == 5, F.lit(None).cast("bigint")).otherwise(pick(17)),
        "DEF": pick(19),
        "Position": F.element_at(F.array(*[F.lit(p) for p in ADAPTER_POSITIONS]),
                                 (k % 17 + 1).cast("int")),
        "OVR": F.lit(50) + k * 3 % 45,
    }


def adapter_frames(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(men, women) raw roster frames derived from customer / supplier."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    k = F.col("c_custkey")
    s = _stats(k)
    men = c.select(
        k.alias("ID"), F.col("c_name").alias("Name"), F.lit("M").alias("GENDER"),
        s["PAC"].alias("PAC"), s["PAS"].alias("PAS"), s["SHO"].alias("SHO"),
        s["PHY"].alias("PHY"), s["DEF"].alias("DEF"), s["Position"].alias("Position"),
        s["OVR"].alias("OVR"), F.col("c_mktsegment").alias("Team"),
        F.concat(F.lit("u/"), k.cast("string")).alias("url"))
    sup = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    k = F.col("s_suppkey")
    s = _stats(k)
    # women's file: no Team column and a different column order
    women = sup.select(
        F.col("s_name").alias("Name"), (F.lit(1000000) + k).alias("ID"),
        s["PAC"].alias("PAC"), s["PAS"].alias("PAS"), s["SHO"].alias("SHO"),
        s["PHY"].alias("PHY"), s["DEF"].alias("DEF"), s["Position"].alias("Position"),
        s["OVR"].alias("OVR"), F.lit("F").alias("GENDER"))
    return men, women


def write_roster_csvs(spark: SparkSession, sf_dir: str, out_dir: str | None = None) -> tuple[str, str]:
    """Write the adapter's men/women CSVs under a shared folder; returns paths."""
    out_dir = out_dir or shared_dir(spark, "roster-csv")
    men, women = adapter_frames(spark, sf_dir)
    men_path, women_path = f"{out_dir}/men_players", f"{out_dir}/women_players"
    men.write.mode("overwrite").option("header", True).csv(men_path)
    women.write.mode("overwrite").option("header", True).csv(women_path)
    return men_path, women_path


def write_damaged_csv(spark: SparkSession, sf_dir: str, out_dir: str) -> list[str]:
    """The adapter's men as CSV lines, of which some are damaged: by id modulo
    40, the last cell missing (1), a cell too many (2), a quote that is not
    closed (3). Returns the columns."""
    men, _ = adapter_frames(spark, sf_dir)
    name = F.when(F.col("ID") % 40 == 3, F.concat(F.lit('"'), "Name")).otherwise(F.col("Name"))
    cells = [F.coalesce(c.cast("string"), F.lit("")) for c in (name if c == "Name" else F.col(c) for c in men.columns)]
    whole, cut = F.concat_ws(",", *cells), F.concat_ws(",", *cells[:-1])
    line = F.when(F.col("ID") % 40 == 1, cut).when(F.col("ID") % 40 == 2, F.concat(whole, F.lit(",x"))).otherwise(whole)
    men.select(line.alias("value")).write.text(out_dir)
    return men.columns


def write_roster_parquet(roster: DataFrame, path: str) -> int:
    """Overwrite the clean roster as Parquet and return the row count,
    measured during the write itself (no second pass over the data)."""
    obs = Observation("roster_rows")
    roster.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return int(obs.get["rows"])
