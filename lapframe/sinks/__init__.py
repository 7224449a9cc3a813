from lapframe.sinks.audit import add_missing_columns, with_audit  # noqa: F401
from lapframe.sinks.layout import write_table  # noqa: F401
from lapframe.sinks.load import load_batch, load_table, read_ledger, read_rejects  # noqa: F401
from lapframe.sinks.publish import CheckFailed, stage_and_publish  # noqa: F401
from lapframe.sinks.report import load_report  # noqa: F401
from lapframe.sinks.upsert import merge_upsert, upsert_table  # noqa: F401
