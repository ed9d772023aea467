"""Column names and codes that are part of the data contract (fixed values)."""

# --- fixed values: change feed columns -------------------------------------
OPERATION = "gwcbi___operation"
PAYLOAD_TS = "gwcbi___payload_ts_ms"
SEQUENCE = "gwcbi___seqval_hex"

# --- fixed values: operation codes -----------------------------------------
OP_INSERT = 0
OP_DELETE = 1
OP_AFTER_IMAGE = 2
OP_UPDATE = 4
UPSERT_OPS = (OP_INSERT, OP_AFTER_IMAGE, OP_UPDATE)

# --- fixed values: replica audit columns -----------------------------------
FINGERPRINT = "GW_FINGERPRINT"
DELIVERY = "GW_TIMESTAMP"
RUN = "CYC_RUN_SK"
AUDIT_TS = "ABC_AUDIT_DATE_TIME"
VALIDATION = "Validation_Flag"
SOFT_DELETE = "Soft_Delete"

# --- fixed values: spatial struct columns stored as hex text -----------------
SPATIAL_COLUMNS = ("spatialpoint", "losslocationspatialdenorm", "spatialpointdenorm")

# --- fixed values: history table columns -------------------------------------
KEY_HASH = "ETL_Key_Hash"
CHANGE_HASH = "ETL_SCD2_Hash"
ACTIVE = "ETL_ActiveRow_Flag"
EFFECTIVE = "ETL_RecordEffective_Date"
EXPIRY = "ETL_RecordExpiry_Date"
CREATED = "ETL_Created_Date"
UPDATED = "ETL_Updated_Date"
LAST_RUN = "ETL_Lst_Updt_Cyc_Sk"
INSERT_RUN = "ETL_Ins_Cyc_SK"
OPEN_END = "9999-12-31 00:00:00"

# --- fixed values: delivery columns excluded from the change hash -------------
DEFAULT_EXCLUSIONS = (
    "cyc_run_sk",
    "soft_delete",
    "gw_fingerprint",
    "gw_timestamp",
    "abc_audit_date_time",
    "ETL_ActiveRow_Flag",
    "ETL_RecordEffective_Date",
    "ETL_RecordExpiry_Date",
    "ETL_Created_Date",
    "ETL_Updated_Date",
    "ETL_Lst_Updt_Cyc_SK",
    "ETL_Ins_Cyc_SK",
)

# Newest delivery first, then newest source change, then newest log position.
RECENCY = (DELIVERY, PAYLOAD_TS, SEQUENCE)
