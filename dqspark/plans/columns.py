"""The columns of the sales file and of the warehouse tables."""

# The columns of the sales file with their staged types.
SALES_TYPES = {
    "product_id": "string",
    "product_name": "string",
    "category": "string",
    "discounted_price": "double",
    "actual_price": "double",
    "discount_percentage": "double",
    "rating": "double",
    "rating_count": "int",
    "about_product": "string",
    "user_id": "string",
    "user_name": "string",
    "review_id": "string",
    "review_title": "string",
    "review_content": "string",
    "img_link": "string",
    "product_link": "string",
}

# The columns of the tables.
DIM_PRODUCT = ["product_id", "product_name", "category", "about_product", "img_link", "product_link"]
DIM_USER = ["user_id", "user_name"]
DIM_RATING = ["user_id", "product_id", "rating", "rating_count"]
FACT_PRODUCT_RATING = ["product_id", "product_name", "avg_rating"]
FACT_SALES_CATEGORY = ["user_id", "category", "sales_amount"]
