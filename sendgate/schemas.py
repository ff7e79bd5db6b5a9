"""Column names, table schemas and the status vocabulary."""

from pyspark.sql import types as T

# The column names, status words and limits are data contracts.
APPL_ID = "APPL_ID"
IMEI = "IMEI"
CODE = "Notification_Code"
FILTER_STATUS = "FILTER_STATUS"
TRIGGER_ID = "TriggerID"

DUE_RENAMES = {
    "LOAN_OVERVIEW_APPL_ID": APPL_ID,
    "LOAN_OVERVIEW_IMEI": IMEI,
}
COPIES = "copies"
PAYLOAD_COLUMNS = [IMEI, CODE, TRIGGER_ID]

NULL = "NULL"
NOT_NULL = "NOT_NULL"
DELINQUENT = "DELINQUENT"
NOT_DELINQUENT = "NOT_DELINQUENT"
DUPLICATE_BIZ = "DUPLICATE_BIZ"
UNIQUE_BIZ = "UNIQUE_BIZ"
DUPLICATE_GLOBAL = "DUPLICATE_GLOBAL"
UNIQUE_GLOBAL = "UNIQUE_GLOBAL"

DAILY_CAP = 3
BATCH_STEP = 1_000_000
SEND_ATTEMPTS = 3
TOKEN_ATTEMPTS = 5
BACKOFF_MIN_SECONDS = 2
BACKOFF_MAX_SECONDS = 20

ITEM_PRIMARY = "Primary"
ITEM_BULK = "BulkNotification"
# End of the fixed values.


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


_TEXT = T.StringType()
_LONG = T.LongType()

# The arriving file is read as text, so that no identifier is rounded by type inference.
DUE_RAW = _schema(LOAN_OVERVIEW_APPL_ID=_TEXT, LOAN_OVERVIEW_IMEI=_TEXT, Notification_Code=_TEXT)

LOAN_FACT = _schema(
    APPL_ID=_LONG, BUCKET=T.IntegerType(), INSTALLMENT_OVERDUE=T.DoubleType(), FIN_REFERENCE=_TEXT
)

STATUS = _schema(
    APPL_ID=_LONG,
    IMEI=_TEXT,
    Notification_Code=_TEXT,
    FILTER_STATUS=_TEXT,
    run_date=T.DateType(),
    business=_TEXT,
    transaction_id=_TEXT,
)

BATCHES = _schema(
    APPL_ID=_LONG,
    IMEI=_TEXT,
    Notification_Code=_TEXT,
    TriggerID=_TEXT,
    row_no=_LONG,
    batch_no=_LONG,
    DATA_C_FILENAME=_TEXT,
    run_date=T.DateType(),
    business=_TEXT,
    transaction_id=_TEXT,
)

SENT = _schema(IMEI=_TEXT, business=_TEXT, transaction_id=_TEXT, sent=_LONG)

COMMIT = _schema(
    version=_LONG,
    run_date=T.DateType(),
    business=_TEXT,
    transaction_id=_TEXT,
    snapshot=_TEXT,
    tables=T.ArrayType(_TEXT),
    token=_TEXT,
)

INIT_LOG = _schema(
    CG_FILENAME=_TEXT,
    TRANSACTION_ID=_TEXT,
    CG_COUNT=_LONG,
    TRANSFORMATIONS=_TEXT,
    ELIGIBLE_COUNT=_LONG,
)

STAGING_LOG = _schema(
    TRANSACTION_ID=_TEXT, CG_FILENAME=_TEXT, DATA_C_FILENAME=_TEXT, BATCH_FILE_COUNT=_LONG
)

ATTEMPTS = _schema(
    filename=_TEXT,
    attempt=T.IntegerType(),
    status=_TEXT,
    status_code=_TEXT,
    api_response=_TEXT,
)

INTENTS = _schema(filename=_TEXT, wave=_LONG)

RESPONSE_LOG = _schema(TRANSACTION_ID=_TEXT, DATA_C_FILENAME=_TEXT, DATA_C_RESPONSE=_TEXT)

OUTCOMES = _schema(DATA_C_FILENAME=_TEXT, status=_TEXT, status_code=_TEXT, api_response=_TEXT)

KPI_LOG = _schema(
    TRANSACTION_ID=_TEXT,
    CG_FILENAME=_TEXT,
    ITEM_TYPE=_TEXT,
    START_TIME=_TEXT,
    END_TIME=_TEXT,
    DURATION_US=_LONG,
)

RUN_LOG = _schema(path=_TEXT, result=_TEXT, retries=T.IntegerType())
