"""Record types, topic names and report labels."""

from __future__ import annotations

from pyspark.sql import types as T


def _record(strings: str, **others: T.DataType) -> T.StructType:
    fields = [T.StructField(n, others.get(n, T.StringType())) for n in strings.split()]
    return T.StructType(fields)


STARTUP_LOG = _record("mid uid appid area os ch type vs ts", ts=T.LongType())
EVENT_LOG = _record("mid uid appid area os type evid pgid npgid itemid ts", ts=T.LongType())
ORDER_INFO = _record(
    "id province_id consignee order_comment consignee_tel order_status payment_way user_id img_url "
    "total_amount expire_time delivery_address create_time operate_time tracking_no parent_order_id "
    "out_trade_no trade_body",
    total_amount=T.DoubleType(),
)
ORDER_DETAIL = _record("id order_id sku_name sku_id order_price img_url sku_num")
USER_INFO = _record("id login_name user_level birthday gender")
SALE_DETAIL = _record(
    "order_detail_id order_id order_status create_time user_id sku_id user_gender user_age user_level "
    "sku_price sku_name dt",
    user_age=T.IntegerType(),
    sku_price=T.DoubleType(),
)

# What a topic carries: the columns a Kafka source would give, as far as they are used.
TOPIC_RECORD = T.StructType(
    [
        T.StructField("value", T.StringType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("offset", T.LongType()),
        T.StructField("topic", T.StringType()),
    ]
)

# Topic names.
TOPIC_START = "TOPIC_START"
TOPIC_EVENT = "TOPIC_EVENT"
TOPIC_ORDER_INFO = "TOPIC_ORDER_INFO"
TOPIC_ORDER_DETAIL = "TOPIC_ORDER_DETAIL"
TOPIC_USER_INFO = "TOPIC_USER_INFO"

# Names shown in the reports.
NAME_DAU = "新增日活"
NAME_NEW_MID = "新增设备"
NAME_GMV = "新增交易额"
TITLE_AGE = "用户年龄占比"
TITLE_GENDER = "用户性别占比"
OPTION_MALE = "男"
OPTION_FEMALE = "女"
OPTION_UNDER_20 = "20岁以下"
OPTION_20_TO_30 = "20岁到30岁"
OPTION_FROM_30 = "30岁及30岁以上"

# The new-device figure is a constant in the report.
NEW_MID_VALUE = 233
