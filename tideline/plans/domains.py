"""The three built-in domains."""

from __future__ import annotations

from tideline.plans.spec import AggregationSpec, AlertSpec, Condition, Domain, EventType, WindowSpec


def _tumbling(size: str) -> WindowSpec:
    return WindowSpec("tumbling", size)


def _sliding(size: str, slide: str) -> WindowSpec:
    return WindowSpec("sliding", size, slide)


# ---- Fixed values: event fields, declared aggregations, alert thresholds and sample lists ----

ECOMMERCE = Domain(
    name="ecommerce",
    entity_key="user_id",
    event_types=(
        EventType(
            "page_view",
            attributes=("page_url", "page_title", "referrer"),
            dimensions=("device_type", "platform", "geo_country"),
        ),
        EventType(
            "product_view",
            attributes=("product_id", "product_name", "product_category"),
            metrics=("product_price",),
            dimensions=("device_type", "platform", "geo_country"),
        ),
        EventType(
            "add_to_cart",
            attributes=("product_id", "product_name", "cart_id"),
            metrics=("quantity", "unit_price"),
            dimensions=("device_type", "platform"),
        ),
        EventType(
            "remove_from_cart",
            attributes=("product_id", "cart_id"),
            metrics=("quantity",),
            dimensions=("device_type",),
        ),
        EventType(
            "purchase",
            attributes=("order_id", "payment_method"),
            metrics=("total_amount", "item_count"),
            dimensions=("currency", "device_type", "geo_country"),
        ),
        EventType(
            "search",
            attributes=("search_query",),
            metrics=("results_count",),
            dimensions=("device_type", "platform"),
        ),
    ),
    aggregations=(
        AggregationSpec("events_per_minute", "count", _tumbling("1 minute"), group_by=("device_type",)),
        AggregationSpec("active_users", "count_distinct", _sliding("5 minutes", "1 minute"), field="entity_id"),
        AggregationSpec(
            "revenue_per_hour",
            "sum",
            _tumbling("1 hour"),
            field="metrics.total_amount",
            where="event_type = 'purchase'",
            group_by=("dimensions.currency",),
            event_types=("purchase",),
        ),
        AggregationSpec(
            "top_products_viewed",
            "count",
            _tumbling("1 hour"),
            where="event_type = 'product_view'",
            group_by=("attributes.product_id", "attributes.product_name"),
            event_types=("product_view",),
        ),
        AggregationSpec(
            "cart_abandonment",
            "count",
            _tumbling("1 hour"),
            where="event_type = 'add_to_cart'",
            group_by=("entity_id",),
            event_types=("add_to_cart",),
        ),
        AggregationSpec(
            "avg_order_value",
            "avg",
            _tumbling("1 hour"),
            field="metrics.total_amount",
            where="event_type = 'purchase'",
            event_types=("purchase",),
        ),
    ),
    alerts=(
        AlertSpec(
            "revenue_drop", Condition("less_than", 1000), "critical", metric="revenue_per_hour", cooldown="5 minutes"
        ),
        AlertSpec(
            "low_traffic", Condition("less_than", 10), "warning", metric="events_per_minute", cooldown="10 minutes"
        ),
        AlertSpec(
            "high_value_order",
            Condition("greater_than", 10000, "metrics.total_amount"),
            "info",
            event_type="purchase",
        ),
    ),
    samples={
        "page_url": ("/", "/products", "/cart", "/checkout", "/search", "/account", "/help"),
        "page_title": ("Home", "Products", "Shopping Cart", "Checkout", "Search", "My Account", "Help"),
        "referrer": ("google.com", "facebook.com", "twitter.com", "direct", "email", ""),
        "device_type": ("mobile", "desktop", "tablet"),
        "platform": ("ios", "android", "web", "macos", "windows"),
        "geo_country": ("US", "UK", "CA", "DE", "FR", "JP", "AU", "BR", "IN", "MX"),
        "product_id": tuple("PROD_%04d" % n for n in range(1, 101)),
        "product_name": ("Laptop", "Phone", "Headphones", "Tablet", "Watch", "Camera", "Speaker", "Monitor"),
        "category": ("electronics", "clothing", "home", "sports", "books", "toys"),
        "currency": ("USD", "EUR", "GBP", "JPY", "CAD"),
        "search_query": ("laptop", "phone case", "headphones", "gift ideas", "sale", "new arrivals"),
    },
    synthetic={
        "user_pool_size": 10000,
        "patterns": {
            "session_duration_avg_minutes": 8,
            "cart_abandonment_rate": 0.70,
            "purchase_conversion_rate": 0.03,
            "peak_hours": (10, 11, 12, 19, 20, 21),
            "weekend_multiplier": 1.3,
        },
    },
)

IOT = Domain(
    name="iot",
    entity_key="device_id",
    event_types=(
        EventType(
            "sensor_reading",
            attributes=("sensor_type", "reading_value", "unit"),
            metrics=(("temperature", "float"), ("humidity", "float"), ("pressure", "float")),
            dimensions=("location", "facility", "sensor_model"),
        ),
        EventType(
            "device_status",
            attributes=("status", "firmware_version", "last_maintenance"),
            metrics=(("battery_level", "float"), ("signal_strength", "float"), ("uptime_seconds", "long")),
            dimensions=("location", "facility"),
        ),
        EventType(
            "alert",
            attributes=("alert_type", "severity", "message", "threshold_value", "actual_value"),
            dimensions=("location", "facility", "alert_category"),
        ),
        EventType(
            "command",
            attributes=("command_type", "parameters", "issued_by"),
            dimensions=("location", "facility"),
        ),
    ),
    aggregations=(
        AggregationSpec(
            "avg_temperature",
            "avg",
            _tumbling("5 minutes"),
            field="metrics.temperature",
            group_by=("location",),
            event_types=("sensor_reading",),
        ),
        AggregationSpec(
            "readings_per_minute",
            "count",
            _tumbling("1 minute"),
            group_by=("facility",),
            event_types=("sensor_reading",),
        ),
        AggregationSpec(
            "alerts_by_severity",
            "count",
            _sliding("15 minutes", "5 minutes"),
            group_by=("severity", "alert_category"),
            event_types=("alert",),
        ),
        AggregationSpec(
            "active_devices",
            "count_distinct",
            _sliding("10 minutes", "1 minute"),
            field="entity_id",
            group_by=("facility",),
        ),
        AggregationSpec(
            "low_battery_devices",
            "count",
            _tumbling("1 hour"),
            where=Condition("lt", 20, "metrics.battery_level"),
            group_by=("facility",),
            event_types=("device_status",),
        ),
    ),
    samples={
        "sensor_type": ("temperature", "humidity", "pressure", "motion", "light"),
        "location": ("warehouse-a", "warehouse-b", "factory-floor", "cold-storage", "loading-dock"),
        "facility": ("north-plant", "south-plant", "distribution-center"),
        "sensor_model": ("TempSense-3000", "HumidMax-Pro", "PressureTech-X1", "MotionEye-500"),
        "status": ("online", "offline", "maintenance", "error"),
        "alert_type": ("threshold_breach", "anomaly_detected", "connection_lost", "battery_low", "maintenance_due"),
        "severity": ("critical", "warning", "info"),
        "alert_category": ("environmental", "connectivity", "hardware", "performance"),
        "command_type": ("restart", "calibrate", "update_firmware", "set_threshold", "diagnostic"),
    },
)

FINTECH = Domain(
    name="fintech",
    entity_key="account_id",
    event_types=(
        EventType(
            "transaction",
            attributes=("transaction_id", "merchant_name", "merchant_category", "description"),
            metrics=(("amount", "money"), ("fee", "money")),
            dimensions=("transaction_type", "currency", "country", "channel"),
        ),
        EventType(
            "login",
            attributes=("ip_address", "user_agent", "session_id"),
            dimensions=("login_status", "auth_method", "device_type", "country"),
        ),
        EventType(
            "fraud_alert",
            attributes=("alert_id", "transaction_id", "reason", "model_version"),
            metrics=(("risk_score", "float"), ("amount", "money")),
            dimensions=("alert_type", "severity", "country"),
        ),
        EventType(
            "account_update",
            attributes=("change_type", "old_value", "new_value", "updated_by"),
            dimensions=("update_category", "channel"),
        ),
        EventType(
            "payment",
            attributes=("payment_id", "recipient_id", "recipient_name", "reference"),
            metrics=(("amount", "money"), ("fee", "money")),
            dimensions=("payment_type", "currency", "status", "country"),
        ),
    ),
    aggregations=(
        AggregationSpec(
            "transaction_volume",
            "sum",
            _tumbling("1 minute"),
            field="metrics.amount_cents",
            group_by=("transaction_type", "currency"),
            event_types=("transaction",),
        ),
        AggregationSpec(
            "transactions_per_minute",
            "count",
            _tumbling("1 minute"),
            group_by=("transaction_type", "country"),
            event_types=("transaction",),
        ),
        AggregationSpec(
            "unique_active_accounts",
            "count_distinct",
            _sliding("5 minutes", "1 minute"),
            field="entity_id",
            group_by=("country",),
            event_types=("transaction", "login", "fraud_alert", "payment"),
        ),
        AggregationSpec(
            "failed_logins",
            "count",
            _tumbling("5 minutes"),
            where=Condition("eq", "failed", "login_status"),
            group_by=("country", "auth_method"),
            event_types=("login",),
        ),
        AggregationSpec(
            "fraud_alerts_by_severity",
            "count",
            _sliding("15 minutes", "5 minutes"),
            group_by=("severity", "alert_type"),
            event_types=("fraud_alert",),
        ),
        AggregationSpec(
            "avg_transaction_value",
            "avg",
            _tumbling("10 minutes"),
            field="metrics.amount_cents",
            group_by=("transaction_type", "currency"),
            event_types=("transaction",),
        ),
        AggregationSpec(
            "high_value_transactions",
            "count",
            _tumbling("1 hour"),
            where=Condition("gt", 100000, "metrics.amount_cents"),
            group_by=("country", "channel"),
            event_types=("transaction",),
        ),
    ),
    samples={
        "transaction_type": ("purchase", "withdrawal", "deposit", "transfer", "refund"),
        "currency": ("USD", "EUR", "GBP", "JPY", "CAD"),
        "country": ("US", "UK", "DE", "JP", "CA", "FR"),
        "channel": ("mobile_app", "web", "atm", "pos_terminal", "api"),
        "merchant_category": ("retail", "grocery", "restaurant", "travel", "entertainment", "utilities"),
        "login_status": ("success", "failed", "locked", "mfa_required"),
        "auth_method": ("password", "biometric", "mfa", "sso"),
        "device_type": ("mobile", "desktop", "tablet"),
        "alert_type": ("unusual_location", "high_amount", "velocity", "device_change", "pattern_mismatch"),
        "severity": ("critical", "high", "medium", "low"),
        "payment_type": ("instant", "scheduled", "recurring", "batch"),
        "status": ("pending", "completed", "failed", "cancelled"),
        "update_category": ("contact_info", "security", "preferences", "limits"),
    },
)

DOMAINS = {d.name: d for d in (ECOMMERCE, IOT, FINTECH)}
