"""Names, fixed values and schemas shared by the whole package."""

from pyspark.sql import types as T

# The message type that marks a recharge line, and the result
# code of a successful order.
MARKER = "reChargeNotifyReq"
SUCCESS_CODE = "0000"

# The only fields of a log line that any metric reads.
ORDER_SCHEMA = T.StructType(
    [
        T.StructField("requestId", T.StringType()),
        T.StructField("bussinessRst", T.StringType()),
        T.StructField("chargefee", T.StringType()),
        T.StructField("provinceCode", T.StringType()),
        T.StructField("receiveNotifyTime", T.StringType()),
    ]
)

# Province code and name.
PROVINCES = [
    ("100", "北京"),
    ("200", "广东"),
    ("210", "上海"),
    ("220", "天津"),
    ("230", "重庆"),
    ("240", "辽宁"),
    ("250", "江苏"),
    ("270", "湖北"),
    ("280", "四川"),
    ("290", "陕西"),
    ("311", "河北"),
    ("351", "山西"),
    ("371", "河南"),
    ("431", "吉林"),
    ("451", "黑龙江"),
    ("471", "内蒙古"),
    ("531", "山东"),
    ("551", "安徽"),
    ("571", "浙江"),
    ("591", "福建"),
    ("731", "湖南"),
    ("771", "广西"),
    ("791", "江西"),
    ("851", "贵州"),
    ("871", "云南"),
    ("891", "西藏"),
    ("898", "海南"),
    ("931", "甘肃"),
    ("951", "宁夏"),
    ("971", "青海"),
    ("991", "新疆"),
]
UNKNOWN_PROVINCE = "none"

# Field names of the four daily totals in a day's hash.
DAILY_FIELDS = {
    "orders": "orders_eachday",
    "suc_orders": "suc_orders_eachday",
    "amount": "amount_eachday",
    "cost_time_ms": "cost_time_eachday",
}

# Every measure is additive, so any roll-up is a sum of a finer one.
MEASURES = ["orders", "suc_orders", "failures", "amount", "cost_time_ms"]

CUBE_SCHEMA = T.StructType(
    [
        T.StructField("order_minute", T.StringType()),
        T.StructField("province", T.StringType()),
        T.StructField("orders", T.LongType()),
        T.StructField("suc_orders", T.LongType()),
        T.StructField("failures", T.LongType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("cost_time_ms", T.LongType()),
    ]
)

# A stored batch: its cube, and a row for each distinct rejected line, which has
# no key and counts in no measure.
LEDGER_SCHEMA = T.StructType(
    CUBE_SCHEMA.fields
    + [
        T.StructField("reject_reason", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("rejected", T.LongType()),
    ]
)

# Names and columns of the two append tables.
FAILURE_TABLE = "failure_perdayprov"
FAILURE_SCHEMA = T.StructType(
    [
        T.StructField("order_date", T.StringType()),
        T.StructField("province", T.StringType()),
        T.StructField("counts", T.LongType()),
    ]
)
SUCCESS_TABLE = "res4"
SUCCESS_SCHEMA = T.StructType(
    [
        T.StructField("order_date", T.StringType()),
        T.StructField("province", T.StringType()),
        T.StructField("isCharged", T.LongType()),
        T.StructField("chargeFee", T.DoubleType()),
    ]
)
