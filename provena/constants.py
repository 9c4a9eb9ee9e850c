"""Fixed values.

Everything in this module must equal the values the original hook emits,
otherwise lineage ids and entity attributes stop matching what a metadata
service already stores.  They are listed plainly, in natural order.
"""

# --- fixed values: identity and entity attributes -------------------------
NAMESPACE = "5k"                      # metadata namespace used in every qualified name
DEFAULT_DB = "default"                # database of an identifier that has none
USER_NAME = "Spark"                   # hive_process.userName
QUERY_PLAN = "Not Supported"          # hive_process.queryPlan
PRODUCER = "sparkhook"                # user of the notification envelope
HOOK_TOPIC = "ATLAS_HOOK"             # topic of hook notifications
MESSAGE_TYPE = "ENTITY_CREATE_V2"     # notification type of one envelope

OP_CTAS = "CREATETABLE_AS_SELECT"     # operationType of a Hive CTAS process
OP_QUERY = "QUERY"                    # operationType of insert / datasource CTAS
FALLBACK_SQL_CTAS = "CREATE_TABLE_AS_SELECT"      # query text when none was captured (CTAS)
FALLBACK_SQL_INSERT = "FROM_TABLE_INSERT_SELECT"  # query text when none was captured (insert)
PROCESS_ID_PREFIX = "QUERY:"          # insert process id = prefix + inputs + infix + target
PROCESS_ID_INFIX = "->:INSERT_OVERWRITE:"
PROCESS_ID_SEP = ":"                  # separator between the inputs of an insert process id

DIRECT_MAPPING = "DirectMapping"      # expression of a bare-relation column mapping
SIMPLE = "SIMPLE"
EXPRESSION = "EXPRESSION"
DEP_TYPE_ATTR = "depenendencyType"    # attribute name, spelled exactly like this

TYPE_PROCESS = "hive_process"
TYPE_COLUMN_LINEAGE = "hive_column_lineage"
TYPE_TABLE = "hive_table"
TYPE_COLUMN = "hive_column"
REL_INPUTS = "dataset_process_inputs"
REL_OUTPUTS = "process_dataset_outputs"
REL_QUERY = "hive_process_column_lineage"

# --- fixed values: delivery ----------------------------------------------------
MAX_RETRIES = 3                       # send attempts
RETRY_INTERVAL_MS = 1000              # wait between attempts

# --- fixed values: Spark's class names of the write commands that are harvested or reported -----
CMD_HIVE_CTAS = "CreateHiveTableAsSelectCommand"
CMD_HIVE_INSERT = "InsertIntoHiveTable"
CMD_DATASOURCE_CTAS = "CreateDataSourceTableAsSelectCommand"
CMD_HADOOP_FS_INSERT = "InsertIntoHadoopFsRelationCommand"

# --- fixed values: Spark's class names of the catalog events ----------------------
CATALOG_KINDS = (
    "CreateDatabaseEvent", "DropDatabaseEvent", "AlterDatabaseEvent",
    "CreateTableEvent", "DropTableEvent", "AlterTableEvent", "RenameTableEvent",
)

# --- our own vocabulary (not from the hook) ---------------------------------------
ROUTE_LINEAGE = "LINEAGE"
ROUTE_FS_WRITE = "FS_WRITE"
ROUTE_UNSUPPORTED = "UNSUPPORTED"

ROOT_PROJECT = "PROJECT"
ROOT_RELATION = "RELATION"
ROOT_OTHER = "OTHER"
ROOT_BAD = "BAD"                      # a plan that cannot be read

BRANCH_PASSTHROUGH = "PASSTHROUGH"
BRANCH_DERIVED = "DERIVED"
BRANCH_DIRECT = "DIRECT"

REASON_NO_SQL_TEXT = "NO_SQL_TEXT"
REASON_LITERAL_LEAF = "LITERAL_LEAF"
REASON_NO_INPUT_TABLE = "NO_INPUT_TABLE"
REASON_UNSUPPORTED = "UNSUPPORTED_COMMAND"
REASON_FS_WRITE = "FS_WRITE"
REASON_BAD_PLAN = "BAD_PLAN"

# Physical plan nodes that tell what an execution did (class names without their package).
NODE_DDL = "ExecutedCommandExec"
NODE_WRITE = "DataWritingCommandExec"
NODE_V2 = "WriteToDataSourceV2Exec"
NODE_UNION = "UnionExec"
