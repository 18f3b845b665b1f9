"""A small shop as raw tables, all text as a CSV scan delivers it."""

COLUMNS = {
    "customers": "customer_id customer_unique_id customer_zip_code_prefix customer_city "
    "customer_state",
    "sellers": "seller_id seller_zip_code_prefix seller_city seller_state",
    "geolocation": "geolocation_zip_code_prefix geolocation_lat geolocation_lng "
    "geolocation_city geolocation_state",
    "categories": "product_category_name product_category_name_english",
    "products": "product_id product_category_name product_name_lenght "
    "product_description_lenght product_photos_qty product_weight_g product_length_cm "
    "product_height_cm product_width_cm",
    "orders": "order_id customer_id order_status order_purchase_timestamp order_approved_at "
    "order_delivered_carrier_date order_delivered_customer_date "
    "order_estimated_delivery_date",
    "order_items": "order_id order_item_id product_id seller_id shipping_limit_date price "
    "freight_value",
    "payments": "order_id payment_sequential payment_type payment_installments payment_value",
    "reviews": "review_id order_id review_score review_comment_title review_comment_message "
    "review_creation_date review_answer_timestamp",
}

ROWS = {
    "customers": [
        ("c1", "u1", "01", "porto", "N"),
        ("c2", "u2", "02", "faro", "S"),
        ("c3", "u1", "01", "porto", "N"),
        ("c4", "u4", "1", "nowhere", "X"),  # zip without leading zero: unknown
        (None, "u5", "01", "porto", "N"),
    ],
    "sellers": [
        ("s1", "01", "porto", "N"),
        ("s2", "99", "nowhere", "X"),
        (None, "01", "porto", "N"),
    ],
    "geolocation": [
        ("01", "41.0", "-8.0", "porto", "N"),
        ("01", "43.0", "junk", "porto", "N"),
        ("02", "37.0", "-7.9", "faro", "S"),
    ],
    "categories": [("brinquedos", "toys"), ("livros", "books")],
    "products": [
        ("p1", "brinquedos", "10", "100", "1", "250", "10", "5", "4"),
        ("p2", "livros", "x", "", None, "q", "20", "3", "15"),
        ("p3", "jardim", "7", "70", "1", "900", "30", "30", "30"),  # untranslated
        ("p4", None, "7", "70", "1", "900", "30", "30", "30"),
    ],
    "orders": [
        ("o1", "c1", "delivered", "2018-01-01 10:00:00", "2018-01-01 11:00:00",
         "2018-01-02 09:00:00", "2018-01-03 18:00:00", "2018-01-05 00:00:00"),
        ("o2", "c2", "delivered", "2018-01-03 23:30:00", "junk",
         "2018-01-04 09:00:00", "2018-01-09 18:00:00", "2018-01-08 00:00:00"),
        ("o3", "c3", "canceled", "2018-01-04 08:00:00", "", None, None,
         "2018-01-20 00:00:00"),
        ("o4", "c4", "delivered", "2018-01-02 08:00:00", None, None, None, None),
        ("o5", "c1", "created", "2018-01-02 08:00:00", None, None, None, None),  # no items
        (None, "c1", "created", "2018-01-02 08:00:00", None, None, None, None),
    ],
    "order_items": [
        *[("o1", str(n), "p1", "s1", "2018-01-02 12:00:00", "10.0", "1.5") for n in range(1, 12)],
        ("o2", "1", "p2", "s1", "2018-01-06 12:00:00", "20.0", None),
        ("o2", "2", "p3", "s1", "2018-01-06 12:00:00", "20.0", "1.0"),
        ("o3", "1", "p1", "s1", "2018-01-04 12:00:00", "30.0", "2.0"),
        ("o3", "2", "p1", "s2", "2018-01-04 12:00:00", "30.0", "2.0"),
        ("o4", "1", "p1", "s1", "2018-01-04 12:00:00", "30.0", "2.0"),
        ("o1", None, "p1", "s1", "2018-01-02 12:00:00", "10.0", "1.5"),
    ],
    "payments": [
        ("o1", "1", "card", "3", "100.0"),
        ("o1", "1", "card", "3", "100.0"),
        ("o1", "2", "voucher", "1", "26.5"),
        ("o2", "1", "slip", "1", "41.0"),
        ("o3", "1", "card", "x", "32.0"),
        ("o4", "1", "card", "1", "32.0"),
        (None, "1", "card", "1", "5.0"),
    ],
    "reviews": [
        ("r1", "o1", "5", None, "good", "2018-01-04", "2018-01-05 10:00:00"),
        ("r2", "o1", "1", "bad", "broken", "2018-01-04", "2018-01-05 11:00:00"),
        ("r3", "o2", "4", None, None, "2018-01-10", "2018-01-11 10:00:00"),
        ("r3", None, "4", None, None, "2018-01-10", "2018-01-11 10:00:00"),
        ("r4", "o4", "3", None, None, "2018-01-10", "2018-01-11 10:00:00"),
        (None, "o3", "3", None, None, "2018-01-10", "2018-01-11 10:00:00"),
    ],
}


def raw(spark, **replaced):
    """The shop's raw tables; keyword arguments replace the rows of a table."""
    tables = {}
    for name, columns in COLUMNS.items():
        schema = ", ".join(f"{c} string" for c in columns.split())
        tables[name] = spark.createDataFrame(replaced.get(name, ROWS[name]), schema)
    return tables
