"""Declared input and table schemas (field names and types are fixed values)."""

from __future__ import annotations

GEO_EVENT = """
event struct<
  admins:array<bigint>, channel_id:bigint, datetime:string, media:struct<media_type:string,src:string>,
  message:string, message_channel_to:bigint, message_from:bigint, message_group:bigint, message_id:bigint,
  message_to:bigint, message_ts:string, reaction_from:string, reaction_type:string,
  subscription_channel:bigint, subscription_user:string, tags:array<string>, user:string>,
event_type string, lat double, lon double, date date
"""

CITY = "id int, city string, lat double, lon double"

USERS_CSV = "id int, chat_name string, registration_dt timestamp, country string, age int"
GROUPS_CSV = "id int, admin_id int, group_name string, registration_dt timestamp, is_private boolean"
DIALOGS_CSV = (
    "message_id int, message_ts timestamp, message_from int, message_to int, message string, message_group int"
)
GROUP_LOG_CSV = "group_id int, user_id int, user_id_from int, event string, datetime timestamp"

STAGED_DOCUMENT = "id bigint, object_id string, object_value string, update_ts timestamp"
RANK = "id bigint, name string, bonus_percent decimal(19,5), min_payment_threshold decimal(19,5)"
BONUS_USER = "id bigint, order_user_id string"
OUTBOX_EVENT = "id bigint, event_ts timestamp, event_type string, event_value string"

# Documents; numbers are read as text and cast where they are used.
ORDER_DOC = """
final_status string, statuses array<struct<status:string,dttm:string>>,
restaurant struct<id:struct<`$oid`:string>>, user struct<id:struct<`$oid`:string>>
"""
RESTAURANT_DOC = "name string, menu array<struct<_id:string,name:string,price:string>>"
DELIVERY_DOC = """
order_id string, order_ts string, delivery_id string, delivery_ts string, courier_id string, address string,
sum string, tip_sum string, rate string
"""
BONUS_DOC = """
order_id string,
product_payments array<struct<product_id:string,quantity:string,price:string,bonus_payment:string,bonus_grant:string>>
"""

CAMPAIGN = """
restaurant_id string, adv_campaign_id string, adv_campaign_content string, adv_campaign_owner string,
adv_campaign_owner_contact string, adv_campaign_datetime_start bigint, adv_campaign_datetime_end bigint,
datetime_created bigint, feedback string
"""
SUBSCRIBER = "id bigint, client_id string, restaurant_id string"

# Numbers are read as the text they arrived in: it feeds the fingerprints.
ORDER_MESSAGE = """
object_id bigint, object_type string, sent_dttm string,
payload struct<
  id:bigint, date:string, cost:string, payment:string, status:string,
  user:struct<id:string,name:string,login:string>, restaurant:struct<id:string,name:string>,
  products:array<struct<id:string,name:string,category:string,quantity:bigint>>>
"""
MART_MESSAGE = """
user_id string, product_id string, product_name string, category_id string, category_name string, quantity bigint,
products array<struct<product_id:string,product_name:string,category_id:string,category_name:string,quantity:bigint>>
"""
