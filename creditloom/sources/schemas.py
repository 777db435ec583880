"""Names and types of the input tables.

Types follow from the column name: keys are long, the columns listed as text are
strings, a few counters are integers, and everything else is a double because it can
be missing. A CSV schema is built from the file's own header by this rule, so extra
or reordered columns do no harm.
"""

from __future__ import annotations

from pyspark.sql import SparkSession, types as T

# Input tables and their text and integer columns.
TABLES = ["application_train", "application_test", "bureau", "bureau_balance", "previous_application",
          "installments_payments", "credit_card_balance", "POS_CASH_balance"]
TEXT_COLUMNS = """
NAME_CONTRACT_TYPE CODE_GENDER FLAG_OWN_CAR FLAG_OWN_REALTY NAME_TYPE_SUITE NAME_INCOME_TYPE
NAME_EDUCATION_TYPE NAME_FAMILY_STATUS NAME_HOUSING_TYPE OCCUPATION_TYPE WEEKDAY_APPR_PROCESS_START
ORGANIZATION_TYPE FONDKAPREMONT_MODE HOUSETYPE_MODE WALLSMATERIAL_MODE EMERGENCYSTATE_MODE
CREDIT_ACTIVE CREDIT_CURRENCY CREDIT_TYPE STATUS
FLAG_LAST_APPL_PER_CONTRACT NAME_CASH_LOAN_PURPOSE NAME_CONTRACT_STATUS NAME_PAYMENT_TYPE
CODE_REJECT_REASON NAME_CLIENT_TYPE NAME_GOODS_CATEGORY NAME_PORTFOLIO NAME_PRODUCT_TYPE
CHANNEL_TYPE NAME_SELLER_INDUSTRY NAME_YIELD_GROUP PRODUCT_COMBINATION
""".split()
INTEGER_COLUMNS = ["TARGET", "MONTHS_BALANCE", "SK_DPD", "SK_DPD_DEF"]


def column_type(name: str) -> T.DataType:
    if name.startswith("SK_ID_"):
        return T.LongType()
    if name in TEXT_COLUMNS:
        return T.StringType()
    return T.IntegerType() if name in INTEGER_COLUMNS else T.DoubleType()


def schema_of(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, column_type(c)) for c in columns])


def header_schema(spark: SparkSession, path: str) -> T.StructType:
    """Schema of a CSV file from its header line."""
    return schema_of(spark.read.option("header", True).csv(path).columns)
