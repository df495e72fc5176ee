"""Derive raw nested records from the generated tables into a landing
folder and write a config document that runs two entity flows on them.

    python examples/prepare_landing.py /root/testdata/sf0.01
    python -m quarry run <printed conf path>
"""

from __future__ import annotations

import json
import os
import sys

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(HERE))

from quarry import fixtures as fx  # noqa: E402
from quarry.session import build_session, run_path  # noqa: E402


def main(sf_dir: str) -> str:
    spark = build_session("local[4]")
    landing = run_path(spark, "example_landing")
    fx.raw_orders(spark, sf_dir).write.mode("overwrite").parquet(f"{landing}/orders")
    fx.raw_events(spark, sf_dir).write.mode("overwrite").parquet(f"{landing}/events")
    warehouse = run_path(spark, "example_warehouse")
    doc = {"conf": [
        {"origin_table": f"{landing}/orders", "destination_table": f"{warehouse}/orders", "flow": "flow3",
         "deduplicate": [{"partitionby": ["_raw_data_orderId", "_raw_data_lines_lineNumber"],
                          "orderby": ["_emitted_at"],
                          "tie_break": ["_raw_data_lines_partKey", "_raw_data_lines_suppKey",
                                        "_raw_data_lines_price"]}],
         "capitalize": ["urgency"],
         "capitalizeword": [{"field": "urgency", "pattern": "^(\\d)-(.*)$", "replacement": "$2 ($1)"}],
         "schema": os.path.join(HERE, "orders.schema.json"), "sql": os.path.join(HERE, "orders.sql"),
         "key": "order_no",
         "target_ddl": "order_no bigint, line_no int, supplier_no bigint, urgency varchar(12), quantity int, "
                       "unit_price double, net_price double"},
        {"origin_table": f"{landing}/events", "destination_table": f"{warehouse}/users_latest", "flow": "flow7",
         "deduplicate": [{"partitionby": ["_raw_data_userId"], "orderby": ["_emitted_at", "_raw_data_event_id"]}],
         "capitalize": ["kind"], "capitalizeword": [], "key": "user_id", "guarded_by": "happened_at",
         "schema": os.path.join(HERE, "events.schema.json"), "sql": os.path.join(HERE, "events.sql"),
         "keep_latest": True},
    ]}
    conf_path = os.path.join(landing.replace("file:", "", 1), "conf.json")
    with open(conf_path, "w", encoding="utf-8") as fh:
        json.dump(doc, fh, indent=1)
    spark.stop()
    return conf_path


if __name__ == "__main__":
    print(main(sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"))
