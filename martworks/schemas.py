"""Declared schemas of the source data, as Spark DDL text."""

from __future__ import annotations

GEO_CITIES = (
    "id int, city string, lat string, lng string")
GEO_EVENT = (
    "event struct<message_from: bigint, message_to: bigint, message_channel_to: bigint, datetime: string,"
    " reaction_from: string, user: string, subscription_channel: bigint>,"
    " event_type string, lat double, lon double"
)
CAMPAIGN = (
    "restaurant_id string, adv_campaign_id string, adv_campaign_content string, adv_campaign_owner string,"
    " adv_campaign_owner_contact string, adv_campaign_datetime_start bigint, adv_campaign_datetime_end bigint,"
    " datetime_created bigint")
ORDER_INCREMENT = (
    "id int, uniq_id string, date_time timestamp_ntz, city_id int, city_name string, customer_id int,"
    " first_name string, last_name string, item_id int, item_name string, quantity int, payment_amount decimal(10,2)")

CHAT_USERS = (
    "id bigint, chat_name string, registration_dt timestamp_ntz, country string, age int")
CHAT_GROUPS = (
    "id bigint, admin_id bigint, group_name string, registration_dt timestamp_ntz, is_private boolean")
CHAT_DIALOGS = (
    "message_id bigint, message_ts timestamp_ntz, message_from bigint, message_to bigint, message string, message_group bigint")
CHAT_GROUP_LOG = (
    "group_id bigint, user_id bigint, user_id_from bigint, event string, datetime timestamp_ntz")

DOC_ORDER = (
    "_id string, user struct<id: string>, restaurant struct<id: string>, final_status string, date string,"
    " cost decimal(14,2), payment decimal(14,2),"
    " order_items array<struct<id: string, quantity: int, price: decimal(14,2)>>")
DOC_RESTAURANT = (
    "_id string, name string, menu array<struct<_id: string, name: string, price: decimal(14,2), category: string>>")
DOC_USER = (
    "_id string, name string, login string")
DOC_COURIER = (
    "_id string, name string")
DOC_BONUS = (
    "order_id string, product_payments array<struct<product_id: string, bonus_payment: decimal(14,2),"
    " bonus_grant: decimal(14,2)>>")
DOC_DELIVERY = (
    "order_id string, order_ts timestamp_ntz, delivery_id string, courier_id string, address string,"
    " delivery_ts timestamp_ntz, sum decimal(14,2), tip_sum decimal(14,2), rate smallint")

ORDER_PAYLOAD = (
    "date string, cost decimal(19,5), payment decimal(19,5), final_status string, restaurant struct<id: string>,"
    " user struct<id: string>, order_items array<struct<id: string, name: string, price: decimal(19,5), quantity: int>>")
ORDER_MESSAGE = f"object_id bigint, object_type string, sent_dttm string, payload struct<{ORDER_PAYLOAD}>"
ENRICHED_ORDER = (
    "object_id bigint, object_type string, payload struct<id: bigint, date: string, cost: decimal(19,5),"
    " payment: decimal(19,5), status: string, restaurant: struct<id: string, name: string>,"
    " user: struct<id: string, name: string, login: string>,"
    " products: array<struct<id: string, price: decimal(19,5), quantity: int, name: string, category: string>>>")
USER_MESSAGE = (
    "order_id bigint, user_id string, product_id_list array<string>, product_name_list array<string>,"
    " category_id_list array<string>, category_name_list array<string>")

WORKFLOW_STATE = (
    "workflow_key string, workflow_settings string, saved_at timestamp_ntz")
