"""Feature derivation (P1-P22) and filters.

Every function is ``DataFrame -> DataFrame`` (use with ``df.transform``) and
adds only narrow, codegen'd projections: no shuffle, valid on a streaming
DataFrame too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxpop.functions import columns as C
from voxpop.schema import BANDS, FEATURE_SETS


def version_filter(df: DataFrame, version: str = "v1") -> DataFrame:
    """F1: V1 keeps every row; V2 keeps ``nps_score > 0`` (drops the zeros)."""
    if version == "v1":
        return df
    if version == "v2":
        return df.filter(F.col("nps_score") > 0)
    raise ValueError(version)


def with_class(df: DataFrame, rule: str = "floor", name: str = "classificacao_nps") -> DataFrame:
    """P1/P2/P3."""
    return df.withColumn(name, C.nps_class("nps_score", rule))


def processed(df: DataFrame, rule: str = "floor") -> DataFrame:
    """The 26-column processed base."""
    flags = {
        "teve_atraso": (F.col("delivery_delay_days") > 0).cast("int"),
        "teve_reclamacao": (F.col("complaints_count") > 0).cast("int"),
        "contatou_sac": (F.col("customer_service_contacts") > 0).cast("int"),
    }
    return (df.withColumn("classificacao_nps", C.nps_class("nps_score", rule))
            .withColumn("eh_detrator", F.coalesce((F.col("classificacao_nps") == "Detrator").cast("int"), F.lit(0)))
            .withColumns(flags)
            .withColumn("severidade_problemas",
                        F.col("teve_atraso") + F.col("teve_reclamacao") + F.col("contatou_sac"))
            .withColumn("desconto_pct", C.ratio_or_zero("discount_value", "order_value")))


def with_bands(df: DataFrame, names=("contact_range", "complaint_range", "resolution_range",
                                     "delay_range", "age_range", "tenure_range")) -> DataFrame:
    """For each band name adds ``<name>`` (label) and ``<name>_id`` (ordinal)."""
    for name in names:
        _, bid, label = C.named_band(name)
        df = df.withColumn(f"{name}_id", bid).withColumn(name, label)
    return df


def service_features(df: DataFrame) -> DataFrame:
    """Service/customer view: select-rule class, <=6 detractor flag, bands,
    rule score and action (P2, P4, P5, P12, P13)."""
    return (with_bands(df)
            .withColumn("classe_nps", C.nps_class("nps_score", "select"))
            .withColumn("is_detractor", C.is_detractor("nps_score", "select"))
            .withColumn("score_risco", C.risk_points())
            .withColumn("acao", C.risk_action("score_risco")))


def logistics_features(df: DataFrame, rule: str = "floor") -> DataFrame:
    """Logistics view: P10, P11, P7 delay flag, P6 band, floor class."""
    return (with_bands(df, ["delay_band_logistics"])
            .withColumn("classificacao_nps", C.nps_class("nps_score", rule))
            .withColumn("freight_ratio", C.ratio_if_positive("freight_value", "order_value"))
            .withColumn("has_multiple_attempts", (F.col("delivery_attempts") > 1).cast("int"))
            .withColumn("teve_atraso", (F.col("delivery_delay_days") > 0).cast("int")))


def breakpoint_features(df: DataFrame) -> DataFrame:
    """P14 (and the unguarded-by-design demo ratio, kept NULL-safe under ANSI)."""
    return df.withColumns({
        "atraso_critico": (F.col("delivery_delay_days") >= 3).cast("int"),
        "reclamacao_alta": (F.col("complaints_count") >= 5).cast("int"),
        "multiplos_contatos": (F.col("customer_service_contacts") >= 3).cast("int"),
        "atraso_x_reclamacao": F.col("delivery_delay_days") * F.col("complaints_count"),
        "freight_ratio": C.safe_div("freight_value", "order_value"),
    })


def model_frame(df: DataFrame, feature_set: str = "ops", rule: str = "select",
                version: str = "v1") -> DataFrame:
    """Base -> every feature any named feature set needs, plus the two
    targets (``label`` = detractor flag, ``nps_score``)."""
    out = processed(version_filter(df, version))
    out = breakpoint_features(out).withColumn("label", C.is_detractor("nps_score", rule))
    num, cat = FEATURE_SETS[feature_set]
    keep = ["order_id", "customer_id", "nps_score", "label"] + num + cat
    seen = []
    for c in keep:
        if c not in seen:
            seen.append(c)
    return out.select(*seen)


def select_report(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Select + rename for a report."""
    return df.select(*[F.col(src).alias(dst) for src, dst in mapping.items()])


def band_dimension(spark, name: str) -> DataFrame:
    """J3 label dimension (band_id, band) of a named banding (tiny, fixed)."""
    labels = BANDS[name][2]
    return spark.createDataFrame([(i, lb) for i, lb in enumerate(labels)], "band_id int, band string")
