from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from starloom.session import local_session  # noqa: E402

# Invented rows; each plants a trap named in the tests that use it.
CUSTOMERS = """customer_id,customer_unique_id,customer_city,customer_state,customer_zip_code_prefix
k-ana,p-1,"	 vila d'água-fria ",ba,470
k-bia,p-2,JOÃO-DE-BARRO,Pe ,55002
k-ana2,p-1,outra vila,AL,57111
k-caio,p-3,três lagos,,8801234
k-duda,,sem dono,TO,77001
k-eva,p-4,n/a,ce,+7
"""

ORDERS = """order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,order_estimated_delivery_date
r11,k-ana,delivered,2019-04-07 08:15:09,2019/04/07 09:00:00,2019-04-20 00:00:00
r12,k-bia,invoiced,2019-12-31T23:59:59.999,, 2020-01-15 12:00:00
r13,k-ana2,shipped,2020-02-29 00:00:01,,2020-03-10 00:00:00
r14,,created,2020-05-05 05:05:05,,
r15,k-caio,approved,08/16/2020,2020-08-16 10:00:00Z,
r16,k-eva,returned,2020-09-01 10:00:00,,
r17,k-eva,unavailable,yesterday,,
r18,k-caio,canceled,2021-01-04 06:30:00,,
"""

ITEMS = """order_id,order_item_id,product_id,price,freight_value
r11,1,s-lamp,41.75,3.10
r12,1,s-rug,260.40,31.05
r12,2,s-shirt,18.99,2.45
r18,1,s-lamp,-1.00,0.50
r15,1,s-ring,77.07,9.99
r15,1,s-toy,6.30,null
r15,3000000000,s-toy,6.35,1.00
r17,4.9,s-rug,2.5f,1e2
r17,?,s-rug,33.33,
r13,1,s-kite,12.00,0x1p3
"""

PRODUCTS = """product_id,product_category_name,product_weight_g
s-lamp,audio,410
s-rug,cama_mesa_banho,5200
s-shirt," Fashion_Roupa_Masculina ",230
s-ring,relogios_presentes,35
s-toy,,120
s-kite,pipas,80
s-lamp,telefonia,415
"""

API = """[
 {"id": 21, "title": "radio", "price": 80.0, "category": "electronics", "rating": {"rate": 2.0, "count": 7}},
 {"id": 22, "title": "phone", "price": 20.0, "category": "ELECTRONICS", "rating": {"rate": 4.0, "count": 9}},
 {"id": 23, "title": "quilt", "price": 64.0, "category": "women's clothing", "rating": {"rate": 3.25, "count": 2}},
 {"id": 24, "title": "watch", "price": 150.0, "category": "jewelery", "rating": 5},
 {"id": 25, "title": "chain", "price": null, "category": "jewelery", "rating": {"rate": 1.5}},
 {"id": 26, "price": 1.0}
]
"""

EVENTS = """event_id,order_id,status,event_timestamp
101,r11,created,2019-04-07 08:20:00
102,r11,approved,2019-04-08 07:00:00
103,r11,,2019-04-10 07:00:00
110,r11,held,2019-04-09 00:00:00
9,r12,shipped,2020-01-02 16:00:00
10,r12,delivered,2020-01-02 16:00:00
104,r12,recalled,2019-12-31 23:59:59
105,r15,canceled,2020-01-01 00:00:00
106,r15,shipped,some day
107,r18,held,2021-02-01 00:00:00
"""


@pytest.fixture(scope="session")
def spark():
    s = local_session(4, 4, app="starloom-tests")
    yield s


@pytest.fixture()
def fixture_dir():
    d = tempfile.mkdtemp(prefix="starloom-fx-", dir="/tmp")
    files = {
        "customers.csv": CUSTOMERS,
        "orders.csv": ORDERS,
        "order_items.csv": ITEMS,
        "products.csv": PRODUCTS,
        "api_products.json": API,
        "order_events.csv": EVENTS,
    }
    for name, text in files.items():
        with open(os.path.join(d, name), "w", encoding="utf-8") as f:
            f.write(text)
    return d


@pytest.fixture()
def raw(spark, fixture_dir):
    from starloom.plans.star import RawSources
    from starloom.sources.csv import read_csv
    from starloom.sources.json_records import read_json_array

    return RawSources(
        customers=read_csv(spark, f"{fixture_dir}/customers.csv", name="customers"),
        orders=read_csv(spark, f"{fixture_dir}/orders.csv", name="orders"),
        order_items=read_csv(spark, f"{fixture_dir}/order_items.csv", name="order_items"),
        products=read_csv(spark, f"{fixture_dir}/products.csv", name="products"),
        api_records=read_json_array(spark, f"{fixture_dir}/api_products.json"),
        order_events=read_csv(spark, f"{fixture_dir}/order_events.csv", name="order_events",
                              required=("order_id", "status", "event_timestamp")),
    )
