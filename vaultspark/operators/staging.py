"""Staging builder (DV-4..9, DV-18): business keys, record source, hash keys,
hash diffs, load date and effective date on top of one ODS slice.

``stage`` is a single ``select``: one narrow, codegen'd projection per row, no
shuffle.  In the pipeline its result is written once per source and year (the
reference's materialised staging view) because several loaders read it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vaultspark.functions.hashing import hash_diff, hash_key
from vaultspark.functions.scalar import inet_text, load_timestamp, year_slice


@dataclass(frozen=True)
class StageSpec:
    """What one source contributes to the vault.

    ``keys``       (KEY column, source columns) -- text copy of the business key;
                   several columns are joined with ``key_separator``.
    ``hash_keys``  (PK column, source columns) -- DV-1 for one column, DV-2 for several.
    ``hash_diffs`` (HASHDIFF column, source columns) -- DV-3.
    ``text_forms`` per-column text conversion applied before keys and hashes
                   (e.g. INET text with its ``/32`` mask).
    """

    name: str
    record_source: str
    columns: tuple[str, ...]
    keys: tuple[tuple[str, tuple[str, ...]], ...]
    hash_keys: tuple[tuple[str, tuple[str, ...]], ...]
    hash_diffs: tuple[tuple[str, tuple[str, ...]], ...]
    effective_from: str
    effective_from_type: str | None = None
    date_column: str | None = None
    date_kind: str = "date"
    text_forms: dict[str, Callable[[Column], Column]] = field(default_factory=dict)
    key_separator: str = " "

    def text(self, c: str) -> Column:
        conv = self.text_forms.get(c)
        return conv(F.col(c)) if conv else F.col(c)


def stage(ods: DataFrame, spec: StageSpec, load_date: dt.datetime | str,
          year: int | None = None) -> DataFrame:
    """Staging rows: source columns, KEYs, RECORD_SOURCE, PKs, HASHDIFFs,
    LOAD_DATE, EFFECTIVE_FROM -- in that order (PR-6..10)."""
    df = ods
    if year is not None and spec.date_column:
        df = df.where(year_slice(spec.date_column, year, spec.date_kind))
    out: list[Column] = [F.col(c) for c in spec.columns]
    for name, cols in spec.keys:
        parts = [spec.text(c).cast("string") for c in cols]
        key = parts[0] if len(parts) == 1 else F.concat_ws(spec.key_separator, *parts)
        out.append(key.alias(name))
    out.append(F.lit(spec.record_source).alias("RECORD_SOURCE"))
    out += [hash_key(*[spec.text(c) for c in cols]).alias(n) for n, cols in spec.hash_keys]
    out += [hash_diff(*[spec.text(c) for c in cols]).alias(n) for n, cols in spec.hash_diffs]
    out.append(load_timestamp(load_date).alias("LOAD_DATE"))
    eff = F.col(spec.effective_from)
    if spec.effective_from_type:
        eff = eff.cast(spec.effective_from_type)
    out.append(eff.alias("EFFECTIVE_FROM"))
    return df.select(*out)


def _k(*pairs: tuple[str, str | tuple[str, ...]]) -> tuple[tuple[str, tuple[str, ...]], ...]:
    return tuple((n, (c,) if isinstance(c, str) else tuple(c)) for n, c in pairs)


# Record-source labels of the reference.
RS_MDM = "MDM - DATA LAKE"
RS_BILLING = "BILLING - DATA LAKE"
RS_PAYMENT = "PAYMENT - DATA LAKE"
RS_ISSUE = "ISSUE - DATA LAKE"
RS_TRAFFIC = "TRAFFIC - DATA LAKE"

MDM = StageSpec(
    name="mdm", record_source=RS_MDM,
    columns=("user_id", "legal_type", "district", "registered_at", "billing_mode", "is_vip"),
    keys=_k(("USER_KEY", "user_id"), ("LEGAL_TYPE_KEY", "legal_type"),
            ("DISTRICT_KEY", "district"), ("BILLING_MODE_KEY", "billing_mode")),
    hash_keys=_k(("USER_PK", "user_id"), ("LEGAL_TYPE_PK", "legal_type"),
                 ("DISTRICT_PK", "district"), ("BILLING_MODE_PK", "billing_mode"),
                 ("MDM_PK", ("user_id", "legal_type", "district", "billing_mode"))),
    hash_diffs=_k(("MDM_HASHDIFF", ("registered_at", "is_vip"))),
    effective_from="registered_at",
)

BILLING = StageSpec(
    name="billing", record_source=RS_BILLING,
    columns=("user_id", "billing_period", "service", "tariff", "sum", "created_at"),
    keys=_k(("USER_KEY", "user_id"), ("BILLING_PERIOD_KEY", "billing_period"),
            ("SERVICE_KEY", "service"), ("TARIFF_KEY", "tariff")),
    hash_keys=_k(("USER_PK", "user_id"), ("BILLING_PERIOD_PK", "billing_period"),
                 ("SERVICE_PK", "service"), ("TARIFF_PK", "tariff"),
                 ("BILLING_PK", ("user_id", "billing_period", "service", "tariff"))),
    hash_diffs=_k(("BILLING_HASHDIFF", ("created_at", "sum"))),
    effective_from="created_at", date_column="created_at", date_kind="date",
)

PAYMENT = StageSpec(
    name="payment", record_source=RS_PAYMENT,
    columns=("user_id", "pay_doc_type", "pay_doc_num", "account", "phone", "billing_period",
             "pay_date", "sum"),
    keys=_k(("USER_KEY", "user_id"), ("ACCOUNT_KEY", "account"),
            ("BILLING_PERIOD_KEY", "billing_period"), ("PAY_DOC_TYPE_KEY", "pay_doc_type"),
            ("PAY_DOC_NUM_KEY", "pay_doc_num")),
    hash_keys=_k(("USER_PK", "user_id"), ("ACCOUNT_PK", "account"),
                 ("BILLING_PERIOD_PK", "billing_period"), ("PAY_DOC_TYPE_PK", "pay_doc_type"),
                 ("PAYMENT_PK", ("user_id", "account", "billing_period", "pay_doc_type"))),
    hash_diffs=_k(("USER_HASHDIFF", ("phone",)),
                  ("PAY_DOC_HASHDIFF", ("pay_doc_num", "pay_date", "sum"))),
    effective_from="pay_date", effective_from_type="timestamp_ntz",
    date_column="pay_date", date_kind="date",
)

ISSUE = StageSpec(
    name="issue", record_source=RS_ISSUE,
    columns=("user_id", "start_time", "end_time", "title", "description", "service"),
    keys=_k(("USER_KEY", "user_id"), ("SERVICE_KEY", "service")),
    hash_keys=_k(("USER_PK", "user_id"), ("SERVICE_PK", "service"),
                 ("ISSUE_PK", ("user_id", "service"))),
    hash_diffs=_k(("ISSUE_HASHDIFF", ("start_time", "end_time", "title", "description"))),
    effective_from="start_time", date_column="start_time", date_kind="timestamp",
)


def traffic_spec(inet_mask: bool = True) -> StageSpec:
    """Traffic staging; ``inet_mask`` keeps the ``/32`` an INET prints with (Q-9)."""
    return StageSpec(
        name="traffic", record_source=RS_TRAFFIC,
        columns=("user_id", "timestamp", "device_id", "device_ip_addr", "bytes_sent",
                 "bytes_received"),
        keys=_k(("USER_KEY", "user_id"), ("DEVICE_KEY", "device_id"),
                ("IP_ADDR_KEY", "device_ip_addr")),
        hash_keys=_k(("USER_PK", "user_id"), ("DEVICE_PK", "device_id"),
                     ("IP_ADDR_PK", "device_ip_addr"),
                     ("TRAFFIC_PK", ("user_id", "device_id", "device_ip_addr"))),
        hash_diffs=_k(("TRAFFIC_HASHDIFF", ("timestamp", "bytes_sent", "bytes_received"))),
        effective_from="timestamp", date_column="timestamp", date_kind="timestamp",
        text_forms={"device_ip_addr": inet_text} if inet_mask else {},
    )


TRAFFIC = traffic_spec()

# Earlier payment-only vault (DV-18).  Its staging views are not in the
# reference; this spec is ours: the payment document is its own hub keyed by
# (pay_doc_type, pay_doc_num), and the payment link key includes it.
EARLY_PAYMENT = StageSpec(
    name="early_payment", record_source=RS_PAYMENT,
    columns=PAYMENT.columns,
    keys=_k(("USER_KEY", "user_id"), ("ACCOUNT_KEY", "account"),
            ("BILLING_PERIOD_KEY", "billing_period"),
            ("PAYDOC_KEY", ("pay_doc_type", "pay_doc_num"))),
    hash_keys=_k(("USER_PK", "user_id"), ("ACCOUNT_PK", "account"),
                 ("BILLING_PERIOD_PK", "billing_period"),
                 ("PAYDOC_PK", ("pay_doc_type", "pay_doc_num")),
                 ("PAY_PK", ("user_id", "account", "billing_period", "pay_doc_type",
                             "pay_doc_num"))),
    hash_diffs=_k(("USER_HASHDIFF", ("phone",)), ("PAY_HASHDIFF", ("sum",))),
    effective_from="pay_date", effective_from_type="timestamp_ntz",
    date_column="pay_date", date_kind="date",
)

SPECS = {"mdm": MDM, "billing": BILLING, "payment": PAYMENT, "issue": ISSUE, "traffic": TRAFFIC}
