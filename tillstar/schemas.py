"""Declared schemas. Raw extracts are read by position and every column is text."""

from __future__ import annotations

from pyspark.sql import types as T

# Header of each extract (in file order) and its snake_case name.
CUSTOMER_COLUMNS = {
    "Customer ID": "customer_id",
    "Age": "age",
    "Gender": "gender",
    "Item Purchased": "item_purchased",
    "Category": "customer_category",
    "Purchase Amount (USD)": "purchase_amount_usd",
    "Location": "location",
    "Size": "size",
    "Color": "color",
    "Season": "season",
    "Review Rating": "review_rating",
    "Subscription Status": "subscription_status",
    "Shipping Type": "shipping_type",
    "Discount Applied": "discount_applied",
    "Promo Code Used": "promo_code_used",
    "Previous Purchases": "previous_purchases",
    "Payment Method": "payment_method",
    "Frequency of Purchases": "purchase_frequency",
}

PRODUCT_COLUMNS = {
    "Uniqe Id": "product_id",
    "Product Name": "product_name",
    "Brand Name": "brand_name",
    "Asin": "asin",
    "Category": "product_category",
    "Upc Ean Code": "upc_ean_code",
    "List Price": "list_price",
    "Selling Price": "selling_price",
    "Quantity": "catalog_quantity",
    "Model Number": "model_number",
    "About Product": "about_product",
    "Product Specification": "product_specification",
    "Technical Details": "technical_details",
    "Shipping Weight": "shipping_weight",
    "Product Dimensions": "product_dimensions",
    "Image": "image_url",
    "Variants": "variants",
    "Sku": "sku",
    "Product Url": "product_url",
    "Stock": "stock",
    "Product Details": "product_details",
    "Dimensions": "dimensions",
    "Color": "product_color",
    "Ingredients": "ingredients",
    "Direction To Use": "direction_to_use",
    "Is Amazon Seller": "is_amazon_seller",
    "Size Quantity Variant": "size_quantity_variant",
    "Product Description": "product_description",
}

ORDER_COLUMNS = {
    "user id": "user_id",
    "product id": "product_id",
    "Interaction type": "interaction_type",
    "Time stamp": "event_ts",
    "Unnamed: 4": "drop_column",
}


def all_text(columns) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


CUSTOMERS_RAW = all_text(CUSTOMER_COLUMNS)
PRODUCTS_RAW = all_text(PRODUCT_COLUMNS)
ORDERS_RAW = all_text(ORDER_COLUMNS)

STG_CUSTOMERS = (
    "customer_id int, age int, gender string, location string, payment_method string, "
    "subscription_status string, previous_purchases int"
)
STG_PRODUCTS = (
    "product_id string, product_name string, product_category string, "
    "selling_price decimal(10,2), brand_name string, model_number string, "
    "image_url string, product_url string, is_amazon_seller string"
)
STG_ORDERS = (
    "user_id int, product_id string, interaction_type string, event_ts timestamp, "
    "event_date date, in_2024 int"
)
DIM_CUSTOMER = (
    "customer_id int, gender string, location string, region string, "
    "payment_method string, subscription_status string, first_seen_date date"
)
DIM_PRODUCT = (
    "product_id string, product_name string, product_category string, "
    "selling_price decimal(10,2)"
)
FACT_SALES = (
    "order_id string, order_date date, customer_id int, product_id string, quantity int, "
    "unit_price decimal(10,2), gross_item_value decimal(12,2), "
    "discount_amount decimal(10,2), tax_amount decimal(10,2), shipping_fee decimal(10,2), "
    "net_revenue decimal(12,2), region string, payment_method string, created_at timestamp"
)
