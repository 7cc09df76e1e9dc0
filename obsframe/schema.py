"""Canonical schemas and fixed values shared by all operators."""

from pyspark.sql import types as T

# The tidy observation table every source is normalised into.
LONG_COLUMNS = ["source", "dataset", "code", "name", "entity", "year", "value"]
LONG_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()),
    T.StructField("dataset", T.StringType()),
    T.StructField("code", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("entity", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("value", T.DoubleType()),
])

# Natural key of one observation (deduplication key).
OBS_KEY = ["source", "dataset", "code", "entity", "year"]

CHECK_RESULT_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("test", T.StringType()),
    T.StructField("check", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("passed", T.BooleanType()),
    T.StructField("observed", T.DoubleType()),
    T.StructField("bound_low", T.DoubleType()),
    T.StructField("bound_high", T.DoubleType()),
    T.StructField("details", T.StringType()),
])

ALERT_SCHEMA = T.StructType([
    T.StructField("severity", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("column_name", T.StringType()),
    T.StructField("observed", T.DoubleType()),
])

# --- fixed values (must equal the reference's behaviour) -----------------------
# Text that means "no entity" in the entity column.
ENTITY_NULL_TOKENS = ["nan", "None", ""]
# Text that means "no value" in a numeric column.
VALUE_NULL_TOKENS = ["", "NA", "NaN"]
# Inclusive range of plausible years.
VALID_YEAR_MIN = 1900
VALID_YEAR_MAX = 2100
# Regex for a year suffix on a wide column name, e.g. hdi_2021.
YEAR_SUFFIX_PATTERN = r"_(\d{4})$"
# Curated codes of the macro panel (compared case-insensitively).
CURATED_CODES = ["ngdpd", "ngdp_rpch", "pcpipch", "ggxwdg_ngdp", "bca_ngdpd", "lur",
                 "sp.pop.totl", "sp.dyn.le00.in", "sl.uem.totl.zs", "ne.exp.gnfs.cd",
                 "ne.imp.gnfs.cd", "fp.cpi.totl.zg", "ny.gdp.mktp.kd.zg", "se.adt.litr.zs"]
# Data-quality thresholds.
NULL_PCT_MAX = 5.0
NULL_PCT_WARN = 5.0
NULL_PCT_CRITICAL = 20.0
Z_SCORE_THRESHOLD = 3.0
ANOMALY_MIN_VALUES = 10
ANOMALY_CRITICAL_PCT = 10.0
VOLUME_DROP_CRITICAL_PCT = 30.0
VOLUME_DROP_WARN_PCT = 10.0
# Freshness tiers: tier -> maximum age in hours.
FRESHNESS_TIER_HOURS = {"critical": 6, "standard": 24, "batch": 168}
