select order_no, line_no, supplier_no, urgency, quantity,
    list_price / quantity as unit_price,
    list_price * (1 - discount) as net_price
from table
