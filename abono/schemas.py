"""Explicit schemas of the raw transactional tables, and their keys."""

RAW_SCHEMAS = {
    "accounts": (
        "account_id int, account_name string, email string,"
        " created_at timestamp_ntz, updated_at timestamp_ntz"),
    "subscriptions": (
        "subscription_id int, subscription_name string, max_contents_per_month int,"
        " created_at timestamp_ntz, updated_at timestamp_ntz"),
    "accounts_subscription": (
        "account_subscription_id int, account_id int, subscription_id int,"
        " start_date date, end_date date"),
    "contents": (
        "content_id int, account_id int, title string, description string,"
        " content_type string, created_at timestamp_ntz, updated_at timestamp_ntz"),
    "content_attributes": (
        "attribute_id int, content_id int, attribute_name string, string_value string,"
        " decimal_value decimal(18,3), date_value date,"
        " created_at timestamp_ntz, updated_at timestamp_ntz"),
    "premium_features": (
        "feature_id int, feature_name string, description string, base_price decimal(10,2),"
        " created_at timestamp_ntz, updated_at timestamp_ntz"),
    "subscription_payments": (
        "payment_id int, account_subscription_id int, payment_date timestamp_ntz,"
        " amount decimal(10,2), payment_method string, billing_cycle string"),
    "account_premium_features": (
        "account_feature_id int, account_id int, feature_id int,"
        " purchase_date timestamp_ntz, amount_paid decimal(10,2)"),
}

RAW_KEYS = {
    "accounts": "account_id",
    "subscriptions": "subscription_id",
    "accounts_subscription": "account_subscription_id",
    "contents": "content_id",
    "content_attributes": "attribute_id",
    "premium_features": "feature_id",
    "subscription_payments": "payment_id",
    "account_premium_features": "account_feature_id",
}

# Relations followed by the post-load integrity check: child -> {column: parent}.
LOAD_RELATIONS = {
    "contents": {"account_id": "accounts"},
    "content_attributes": {"content_id": "contents"},
    "accounts_subscription": {"account_id": "accounts", "subscription_id": "subscriptions"},
}

# Money totals are wider than single amounts.
MONEY = "decimal(20,2)"
