"""Table layouts: landing is all text, staging is typed, the warehouse is a star.

Fixed values: names of tables and of columns without a leading underscore. Durations, changes and
ranges are wider than in the design, so that no value of the price type is lost.
"""

from __future__ import annotations

PRICE_TEXT = ("date", "open", "high", "low", "close", "volume")

LINEAGE = "_source_name string, _source_filename string, _loaded_at timestamp_ntz"
LINEAGE_COLUMNS = ("_source_name", "_source_filename", "_loaded_at")

PROFILE_TEXT = (
    "symbol", "company_name", "exchange", "exchange_full_name", "industry", "currency", "website",
    "description", "ceo", "sector", "country", "full_time_employees", "city", "state", "zip",
    "address", "ipo_date", "is_active", "is_etf", "is_fund",
)

_BAR = (
    "symbol string, symbol_type string, interval_start timestamp_ntz, timezone string, "
    "open decimal(18,6), high decimal(18,6), low decimal(18,6), close decimal(18,6), "
    "volume bigint, trade_count int, granularity string"
)

COMPANY = (
    "symbol string, company_name string, ceo string, currency string, sector string, "
    "industry string, full_time_employees int, country string, state string, city string, "
    "zip string, address string, exchange string, exchange_full_name string, ipo_date date, "
    "is_active boolean, is_etf boolean, is_fund boolean, " + LINEAGE
)

# Sort order inside files, so that Parquet statistics skip what a time filter rules out.
FILE_ORDER = {
    "stg_stock_price": "trade_date",
    "agg_15min_raw": "interval_start",
    "fact_15min_stock_price": "fk_date_id",
}

# A write to these goes to a single partition, so its rows need no shuffle to meet there.
ONE_PARTITION_A_WRITE = ("landing_prices", "rejected_prices", "elt_control")

# Widths of columns in the design. Spark's text and wider numbers hold more, so a value
# beyond them is loaded, and logged.
LENGTHS: dict[str, dict[str, int]] = {
    "dim_date": {"day_name": 20, "month_name": 20, "granularity": 20, "timezone": 50},
    "dim_exchange": {"exchange_code": 10, "exchange_name": 255},
    "dim_company": {
        "symbol": 10, "company_name": 255, "ceo": 255, "currency": 10, "sector": 100, "industry": 100,
        "country": 100, "state": 100, "city": 100, "zip": 20, "address": 255,
    },
    "dim_instrument": {"instrument_type": 50, "symbol": 10, "name": 255, "currency": 10},
    "dim_trade_status": {"agg_status": 20},
}
# Digits before the point.
FACT_DIGITS = {"price_change": 12, "price_change_pct": 4, "price_range": 12}

# name -> (columns, partition columns)
TABLES: dict[str, tuple[str, tuple[str, ...]]] = {
    "landing_prices": (
        "symbol string, " + ", ".join(f"{c} string" for c in PRICE_TEXT) + f", {LINEAGE}, _path string, _landing string, load_date date",
        ("load_date",),
    ),
    # landings that are complete, and the staging batch that each one belongs to
    "landing_log": ("_landing string, load_date date", ()),
    "staged_landings": ("_landing string, load_date date, batch_id bigint", ()),
    "landing_sectors": (f"symbol string, sector string, {LINEAGE}", ()),
    "landing_profiles": (", ".join(f"{c} string" for c in PROFILE_TEXT) + f", {LINEAGE}", ()),
    "ingest_log": (
        "_source_filename string, path string, symbol string, rows bigint, status string, error string, "
        "_loaded_at timestamp_ntz, _landing string",
        (),
    ),
    "stg_stock_price": (
        "ticker_symbol string, trade_date timestamp_ntz, timezone string, "
        "open_price decimal(18,6), high_price decimal(18,6), low_price decimal(18,6), "
        "close_price decimal(18,6), volume bigint, symbol_type string, _source_name string, "
        "_source_filename string, _is_cleaned boolean, _is_duplicate boolean, _audit_hash string, "
        "_loaded_at timestamp_ntz, _batch_id bigint, trade_part date",
        ("trade_part",),
    ),
    "staging_log": ("trade_part date, batch_id bigint, compacted boolean", ()),
    # attempts at staging a batch: a row when one begins, and one when the batch is whole
    "staging_attempts": ("batch_id bigint, attempt string, done boolean", ()),
    "rejected_prices": (
        "symbol string, " + ", ".join(f"{c} string" for c in PRICE_TEXT)
        + f", {LINEAGE}, reject_reason string, _batch_id bigint, load_date date",
        ("load_date",),
    ),
    "stg_companies": (COMPANY, ()),
    "agg_15min_raw": (f"{_BAR}, yyyymm int", ("yyyymm",)),
    # months of a table that a version changes, and (settled) up to which version they are rewritten
    "delta_log": ("name string, yyyymm int, version bigint, settled boolean", ()),
    "bar_days": (
        "symbol string, trade_day date, n_bars bigint, last_close decimal(18,6), yyyymm int",
        ("yyyymm",),
    ),
    "dim_date": (
        "sk_date_id bigint, datetime timestamp_ntz, date date, hour int, minute int, second int, "
        "day_of_week int, day_name string, day_of_month int, day_of_year int, week_of_month int, "
        "week_of_year int, month int, month_name string, year int, quarter int, "
        "is_weekend boolean, is_holiday boolean, fiscal_year int, fiscal_quarter int, "
        "granularity string, is_pre_market boolean, is_regular_session boolean, "
        "is_after_hours boolean, timezone string, is_early_close boolean, yyyymm int",
        ("yyyymm",),
    ),
    "dim_exchange": ("sk_exchange_id bigint, exchange_code string, exchange_name string", ()),
    "dim_company": (
        "sk_company_id bigint, symbol string, company_name string, ceo string, currency string, "
        "sector string, industry string, full_time_employees int, country string, state string, "
        "city string, zip string, address string, ipo_date date, is_active boolean, "
        "is_etf boolean, is_fund boolean, row_effective_ts timestamp_ntz, "
        "row_end_ts timestamp_ntz, key_bucket string",
        ("key_bucket",),
    ),
    "dim_instrument": (
        "sk_instrument_id bigint, instrument_type string, symbol string, name string, currency string",
        (),
    ),
    "dim_trade_status": ("sk_status_id bigint, agg_status string, agg_trade_count int", ()),
    "dim_meta_audit_log": (
        "sk_audit_id bigint, source_system string, row_count_raw bigint, "
        "row_count_rejected bigint, execution_start_ts timestamp_ntz, "
        "execution_end_ts timestamp_ntz, execution_time decimal(12,2), status string",
        (),
    ),
    # rules that rows of a run break without stopping it
    "load_checks": ("fk_audit_id bigint, rule string, violations bigint", ()),
    "elt_control": (
        "id bigint, last_processed timestamp_ntz, last_batch_id bigint, "
        "last_run_ts timestamp_ntz, status string, settings string, job_name string",
        ("job_name",),
    ),
    "fact_15min_stock_price": (
        "fk_date_id bigint, fk_instrument_id bigint, fk_exchange_id bigint, fk_audit_id bigint, "
        "fk_company_id bigint, fk_status_id bigint, open_price decimal(18,6), "
        "high_price decimal(18,6), low_price decimal(18,6), close_price decimal(18,6), "
        "volume bigint, adj_close decimal(18,6), vwap decimal(18,6), "
        "previous_close decimal(18,6), price_change decimal(19,6), "
        "price_change_pct decimal(24,3), price_range decimal(19,6), yyyymm int",
        ("yyyymm",),
    ),
}
