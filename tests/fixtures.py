"""Invented landing files (source shape) covering the edge cases of each job.

Values are exact binary fractions so that plain double sums in the brute-force
checks are exact too.
"""

from __future__ import annotations

import os

from emporia.sources.registry import SOURCE_FILES

LANDING: dict[str, str] = {
    # repeated id with differing city; outer spaces and capitals; zip without a
    # centroid; NULL zip; an undeclared column in the middle.
    "customers": (
        "customer_id,customer_unique_id,customer_note,customer_zip_code_prefix,customer_city,customer_state\n"
        "c1,u1,x,1151,  Sao Paulo ,SP\n"
        "c1,u1,y,01151,campinas,SP\n"
        "c2,u2,x,99999,Rio de Janeiro,RJ\n"
        "c3,u3,x,,curitiba,PR\n"
        "c4,u4,x,20000,NITEROI, rj \n"
    ),
    # three points for one zip (two spellings), two for another, one NULL latitude.
    "geolocation": (
        "geolocation_zip_code_prefix,geolocation_lat,geolocation_lng,geolocation_city\n"
        "01151,-23.0,-46.0,sao paulo\n"
        "1151,-23.5,-46.5,sao paulo\n"
        "01151,-24.0,-47.0,sao paulo\n"
        "20000,-22.75,-43.0,niteroi\n"
        "20000,,-43.5,niteroi\n"
    ),
    "sellers": (
        "seller_id,seller_zip_code_prefix,seller_city,seller_state\n"
        "s1,20000,Rio,RJ\n"
        "s1,20000, Angra ,RJ\n"
        "s2,,Belo Horizonte,MG\n"
    ),
    # known, unknown and NULL category.
    "products": (
        "product_id,product_category_name,product_name_lenght,product_weight_g,"
        "product_length_cm,product_height_cm,product_width_cm\n"
        "p1,beleza_saude,40,500,10,11,12\n"
        "p2,unknown_cat,40,100,5,5,5\n"
        "p3,,40,200,,,\n"
    ),
    # UTF-8 byte-order mark on the header.
    "product_category_translation": (
        "﻿product_category_name,product_category_name_english\n"
        "beleza_saude,health_beauty\n"
        "esporte_lazer,sports_leisure"
    ),
    # delivered; not delivered; delivered before purchase; 23:59 -> 00:01; NULL
    # status with unknown customer; NULL purchase time; a repeated order id.
    "orders": (
        "order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
        "order_delivered_customer_date\n"
        "o1,c1,delivered,2018-01-01 23:59:00,x,2018-01-02 00:01:00\n"
        "o2,c2,shipped,2018-01-05 10:00:00,x,\n"
        "o3,c3,delivered,2018-01-10 08:00:00,x,2018-01-05 08:00:00\n"
        "o4,c9,,2018-01-01 12:00:00,x,\n"
        "o5,c4,delivered,,x,\n"
        "o6,c1,delivered,2018-01-01 09:00:00,x,2018-01-03 09:00:00\n"
        "o6,c4,delivered,2018-01-02 09:00:00,x,2018-01-03 09:00:00\n"
    ),
    # repeated key with differing price; NULL freight; unknown product, order
    # and seller.
    "order_items": (
        "order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\n"
        "o1,1,p1,s1,x,100.0,10.0\n"
        "o1,1,p1,s1,x,90.0,10.0\n"
        "o1,2,p2,s2,x,50.5,\n"
        "o2,1,p3,s1,x,20.0,2.5\n"
        "o3,1,p9,s2,x,10.0,1.0\n"
        "o7,1,p1,s1,x,5.0,0.5\n"
        "o6,1,p1,s9,x,7.25,0.75\n"
        "o6,2,p1,s1,x,7.25,0.75\n"
        "o5,1,p3,s2,x,3.0,1.0\n"
    ),
    "order_payments": (
        "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
        "o1,1, Credit_Card ,3,110.0\n"
        "o2,1,boleto,1,22.5\n"
    ),
    # scores 5, ' 4 ', abc, 1.5, NULL; quoted text with a line break, a comma and
    # a doubled quote; text ending in a tab; two reviews of an order with two items.
    "order_reviews": (
        "review_id,order_id,review_score,review_comment_title,review_comment_message\n"
        'r1,o1,5,,"Great, fast ""really"" good\nsecond line "\n'
        "r2,o1, 4 ,,ends in tab\t\n"
        "r3,o2,abc,,\n"
        "r4,o3,1.5,,  ok  \n"
        "r5,o6,,,\n"
        "r6,o9,3,,unknown order\n"
    ),
}


def write_landing(folder: str, overrides: dict[str, str] | None = None) -> str:
    """Write the landing files under their registry names; returns the folder."""
    os.makedirs(folder, exist_ok=True)
    for dataset, text in {**LANDING, **(overrides or {})}.items():
        with open(os.path.join(folder, SOURCE_FILES[dataset]), "w", encoding="utf-8") as fh:
            fh.write(text)
    return folder
