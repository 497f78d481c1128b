"""Declared schemas of the raw sources, the ODS layer and the vault/mart tables."""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DateType()
TS, DBL, B, SH = T.TimestampNTZType(), T.DoubleType(), T.BooleanType(), T.ShortType()
PHONE = T.DecimalType(11, 0)


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# --- raw sources (STG) -----------------------------------------------------------

STG_BILLING = _schema(("user_id", I), ("billing_period", S), ("service", S), ("tariff", S),
                      ("sum", S), ("created_at", D))
STG_ISSUE = _schema(("user_id", S), ("start_time", TS), ("end_time", TS), ("title", S),
                    ("description", S), ("service", S))
STG_PAYMENT = _schema(("user_id", I), ("pay_doc_type", S), ("pay_doc_num", I), ("account", S),
                      ("phone", PHONE), ("billing_period", S), ("pay_date", D), ("sum", DBL))
STG_TRAFFIC = _schema(("user_id", I), ("timestamp", L), ("device_id", S), ("device_ip_addr", S),
                      ("bytes_sent", I), ("bytes_received", I))
MDM_USER = _schema(("id", I), ("legal_type", S), ("district", S), ("registered_at", TS),
                   ("billing_mode", S), ("is_vip", B))

STG = {"billing": STG_BILLING, "issue": STG_ISSUE, "payment": STG_PAYMENT, "traffic": STG_TRAFFIC}

# --- typed layer (ODS) -------------------------------------------------------------

ODS_BILLING = _schema(("user_id", I), ("billing_period", D), ("service", S), ("tariff", S),
                      ("sum", I), ("created_at", D))
ODS_ISSUE = _schema(("user_id", I), ("start_time", TS), ("end_time", TS), ("title", S),
                    ("description", S), ("service", S))
ODS_PAYMENT = _schema(("user_id", I), ("pay_doc_type", S), ("pay_doc_num", I), ("account", S),
                      ("phone", PHONE), ("billing_period", D), ("pay_date", D), ("sum", I))
ODS_TRAFFIC = _schema(("user_id", I), ("timestamp", TS), ("device_id", S), ("device_ip_addr", S),
                      ("bytes_sent", L), ("bytes_received", L))
ODS_USER = _schema(("user_id", I), ("legal_type", S), ("district", S), ("registered_at", D),
                   ("billing_mode", S), ("is_vip", B))

ODS = {"billing": ODS_BILLING, "issue": ODS_ISSUE, "payment": ODS_PAYMENT,
       "traffic": ODS_TRAFFIC, "user": ODS_USER}

# Column whose year decides the ODS partition of a row.
ODS_DATE_COLUMN = {"billing": "created_at", "issue": "start_time", "payment": "pay_date",
                   "traffic": "timestamp"}


# --- vault ----------------------------------------------------------------------------

def hub_schema(name: str) -> T.StructType:
    p = name.upper()
    return _schema((f"{p}_PK", S), (f"{p}_KEY", S), ("LOAD_DATE", TS), ("RECORD_SOURCE", S))


LINK_PAYMENT = _schema(("PAYMENT_PK", S), ("USER_PK", S), ("ACCOUNT_PK", S),
                       ("BILLING_PERIOD_PK", S), ("PAY_DOC_TYPE_PK", S),
                       ("LOAD_DATE", TS), ("RECORD_SOURCE", S))
SAT_USER = _schema(("USER_PK", S), ("USER_HASHDIFF", S), ("phone", PHONE),
                   ("EFFECTIVE_FROM", TS), ("LOAD_DATE", TS), ("RECORD_SOURCE", S))
SAT_PAYMENT = _schema(("PAYMENT_PK", S), ("PAY_DOC_HASHDIFF", S), ("pay_doc_num", I),
                      ("pay_date", D), ("sum", I), ("EFFECTIVE_FROM", TS), ("LOAD_DATE", TS),
                      ("RECORD_SOURCE", S))
SAT_MDM = _schema(("MDM_PK", S), ("MDM_HASHDIFF", S), ("registered_at", TS), ("is_vip", B),
                  ("EFFECTIVE_FROM", TS), ("LOAD_DATE", TS), ("RECORD_SOURCE", S))

# Earlier payment-only vault (DV-18)
LINK_PAYDOC_PAYMENT = _schema(("PAY_PK", S), ("PAYDOC_PK", S), ("USER_PK", S), ("ACCOUNT_PK", S),
                              ("BILLING_PERIOD_PK", S), ("LOAD_DATE", TS), ("RECORD_SOURCE", S))
SAT_PAY = _schema(("PAY_PK", S), ("PAY_HASHDIFF", S), ("sum", I), ("EFFECTIVE_FROM", TS),
                  ("LOAD_DATE", TS), ("RECORD_SOURCE", S))

# --- mart ----------------------------------------------------------------------------

REPORT = _schema(("billing_year", SH), ("legal_type", S), ("district", S),
                 ("registration_year", SH), ("billing_mode", S), ("is_vip", B), ("tot_sum", L))
FACT = _schema(("billing_year_id", SH), ("legal_type_id", SH), ("district_id", SH),
               ("registration_year_id", SH), ("billing_mode_id", SH), ("is_vip", B),
               ("tot_sum", L))
