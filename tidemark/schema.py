"""Fixed names and schemas of redo logs, offsets and envelopes."""

from __future__ import annotations

from pyspark.sql.types import StructType

#: Operation codes of a redo log.  Fixed values.
INSERT, DELETE, UPDATE, COMMIT, ROLLBACK = 1, 2, 3, 7, 36
#: Letters of operations in envelopes.  Fixed values.
OPS = {"READ": "r", "UPDATE": "u", "INSERT": "i", "DELETE": "d"}
#: Users whose terminators are not of interest.  Fixed values.
INTERNAL_USERS = ("UNKNOWNX", "KMINER")
#: The status of a change that could not be read, the mark of temporary tables' changes, and what a snapshot's rows have for a transaction.
UNREADABLE, TEMPORARY, NO_TRANSACTION = 2, "temporary tables", "NOT AVAILABLE"
#: The version in source blocks.
VERSION = "1.0"

_LOG = {
    "seq": "long", "scn": "long", "timestamp": "timestamp", "operation": "string", "operation_code": "integer", "rollback": "integer", "seg_owner": "string", "table_name": "string",
    "username": "string", "sql_redo": "string", "row_id": "string", "csf": "integer", "xid": "string", "status": "integer",
}
LOG = StructType.fromJson({"fields": [{"name": k, "type": t, "nullable": True, "metadata": {}} for k, t in _LOG.items()]})
#: Columns that a scan reads for its result (rollback and operation_code are read for its filter).
LOG_COLUMNS = ["seq", "scn", "timestamp", "operation", "seg_owner", "table_name", "username", "sql_redo", "row_id", "csf", "xid", "status"]
CDC_OFFSET = "struct<type:string,scn:bigint,commitScn:bigint,isTransactionComplete:boolean>"
SNAPSHOT_OFFSET = "struct<type:string,scn:bigint,owner:string,table:string,rowId:string>"
