"""Explicit schemas of the five entities.

Fixed values: field names and types of the source documents.  Never inferred, because
inference turns the cart map into a struct with one field per product id.  ``RAW`` is what
the JSON reader is given: numbers and booleans as text, since documents write them either
way; the functions in ``operators.clean`` cast them.
"""

import re

USERS = """
    user_id string,
    geo_data struct<city:string, state:string, country:string>,
    registration_date string,
    last_active string
"""

CATEGORIES = """
    category_id string,
    name string,
    subcategories array<struct<subcategory_id:string, name:string, profit_margin:double>>
"""

PRODUCTS = """
    product_id string,
    name string,
    category_id string,
    subcategory_id string,
    base_price double,
    current_stock int,
    is_active boolean,
    price_history array<struct<price:double, date:string>>,
    creation_date string
"""

TRANSACTIONS = """
    transaction_id string,
    session_id string,
    user_id string,
    timestamp string,
    items array<struct<product_id:string, quantity:int, unit_price:double, subtotal:double>>,
    subtotal double,
    discount double,
    total double,
    payment_method string,
    status string
"""

SESSIONS = """
    session_id string,
    user_id string,
    start_time string,
    end_time string,
    duration_seconds int,
    geo_data struct<city:string, state:string, country:string, ip_address:string>,
    device_profile struct<type:string, os:string, browser:string>,
    viewed_products array<string>,
    page_views array<struct<timestamp:string, page_type:string, product_id:string,
                            category_id:string, view_duration:int>>,
    cart_contents map<string, struct<quantity:int, price:double>>,
    conversion_status string,
    referrer string
"""

BY_ENTITY = {
    "users": USERS,
    "categories": CATEGORIES,
    "products": PRODUCTS,
    "transactions": TRANSACTIONS,
    "sessions": SESSIONS,
}

RAW = {name: re.sub(r"\b(double|int|boolean)\b", "string", ddl) for name, ddl in BY_ENTITY.items()}
