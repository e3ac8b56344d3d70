"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from .base_sql import PRIVATE_SQL, QUALITY_SQL, SECRET_SQL
from .bpe import op6_bpe
from .common import documents
from .exact_dedup import OP1_SQL, op1_exact_dedup
from .langid import op9_langid
from .packing import op7_packing
from .pii import op4_pii
from .quality import op10_quality, with_base
from .secrets import op8_secrets
from .simhash import op3_simhash
from .substring import OP2_SQL, op2_substring_dedup
from .toxicity import op5_toxicity


def base_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can say of op4."""
    return op4_pii(spark, sf_dir).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")


def base_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can say of op8."""
    return op8_secrets(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")


def base_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SQL can say of op10: the same step over all documents, without the training that only kept and llr need."""
    return with_base(documents(spark, sf_dir)).drop("h")


QUERIES = {f.__name__: f for f in (op1_exact_dedup, op2_substring_dedup, op3_simhash, op4_pii, op5_toxicity, op6_bpe, op7_packing, op8_secrets, op9_langid, op10_quality, base_private, base_secrets, base_quality)}
ORACLE_SQL = {"op1_exact_dedup": OP1_SQL, "op2_substring_dedup": OP2_SQL, "base_private": PRIVATE_SQL, "base_secrets": SECRET_SQL, "base_quality": QUALITY_SQL}
