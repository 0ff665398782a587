"""A small price list from which the sample derives one contract per billing customer (plain data)."""

from __future__ import annotations

# code, position, invoice line title, product (None: a line without a price), base net total
LINES = [
    ("cashout", 1, "Cash-out", "Cash-out", "110.00"),
    ("cashin", 2, "Cash-in", "Cash-in", "90.00"),
    ("debit", 3, "Direct debit", "Direct debit", "75.00"),
    ("cross", 4, "Cross-border", "Cross-border", "60.00"),
    ("priority", 5, "Priority bank", "Priority bank", "55.00"),
    ("api", 6, "API calls", "API calls", "40.00"),
    ("any", 7, "Any movement", "Any movement", "35.00"),
    ("mixed", 8, "Mixed tiers", "Mixed tiers", "30.00"),
    ("empty", 9, "Empty tiers", "Empty tiers", "0.00"),
    ("fee", 10, "Platform fee", "Platform fee", "100.50"),
    ("disc_bank", 11, "Discount", "Priority bank", "-12.50"),
    ("disc_all", 12, "Discount", None, "-20.25"),
    ("disc_new", 13, "New discount", "Onboarding", "-7.40"),
    ("trueup", 14, "True up charge", None, "250.50"),
    ("legacy", 15, "Legacy", "Legacy", "15.00"),
    ("season", 16, "Seasonal", "Seasonal", "22.00"),
]

# code of the line whose price it belongs to, status, start, end, archived, base minimum, price structure
PHASES = [
    ("cashout", "ACTIVE", "1997-06-01", None, False, "1500.00",
     '{"pricingType":"LINEAR","pricePerUnit":"0.25","isPricePercentage":true,"usageMetricId":"um_cashout"}'),
    ("cashin", "ACTIVE", "1997-06-01", None, False, None,
     '{"pricingType":"VOLUME","usageMetricId":"um_cashin","tiers":['
     '{"price":"20","fee":"1","upperBound":"3","isPricePercentage":false},'
     '{"price":"15.5","upperBound":"8","isPricePercentage":false},'
     '{"price":"10","fee":"0","isPricePercentage":false}]}'),
    ("debit", "COMPLETED", "1997-06-01", "1998-12-31", False, "900.00",
     '{"pricingType":"graduated","usageMetricId":"um_debit","tiers":['
     '{"price":"30","fee":"2","upperBound":"2","isPricePercentage":false},'
     '{"price":"25","fee":"1","upperBound":"5","isPricePercentage":false},'
     '{"price":"18","isPricePercentage":false}]}'),
    ("cross", None, "1997-06-01", None, False, None,
     '{"pricingType":"VOLUME","usageMetricId":"um_cross","tiers":['
     '{"price":"0.5","fee":"0","upperBound":"400000","isPricePercentage":true},'
     '{"price":"0.4","fee":"5","upperBound":"1200000","isPricePercentage":true},'
     '{"price":"0.3","isPricePercentage":true}]}'),
    ("priority", "ACTIVE", "1997-06-01", None, False, "700.00",
     '{"pricingType":"GRADUATED","usageMetricId":"um_priority","tiers":['
     '{"price":"0.2","fee":"3","upperBound":"300000","isPricePercentage":true},'
     '{"price":"0.15","fee":"2","upperBound":"900000","isPricePercentage":true},'
     '{"price":"0.1","isPricePercentage":true}]}'),
    ("api", "ACTIVE", "1997-06-01", None, False, None,
     '{"pricingType":"LINEAR","pricePerUnit":"0.75","isPricePercentage":false,"usageMetricId":"um_api"}'),
    ("any", "ACTIVE", "1997-06-01", None, False, None,
     '{"pricingType":"LINEAR","pricePerUnit":"0.01","isPricePercentage":true}'),
    ("mixed", "ACTIVE", "1997-06-01", None, False, None,
     '{"pricingType":"VOLUME","usageMetricId":"um_mixed","tiers":['
     '{"price":"9","fee":"1","upperBound":"6","isPricePercentage":false},'
     '{"price":"0.05","fee":"0.5","upperBound":"500000","isPricePercentage":true},'
     '{"price":"7","isPricePercentage":false}]}'),
    ("empty", "ACTIVE", "1997-06-01", None, False, None,
     '{"pricingType":"VOLUME","usageMetricId":"um_empty","tiers":[]}'),
    ("fee", "ACTIVE", "1997-06-01", None, False, "400.00", '{"pricingType":"FIXED","price":"100.50"}'),
    ("disc_new", "DRAFT", "1997-06-01", None, False, "50.00", '{"pricingType":"FIXED","price":"-5.00"}'),
    ("legacy", "ACTIVE", "1997-06-01", None, True, None,
     '{"pricingType":"LINEAR","pricePerUnit":"1.00","isPricePercentage":false,"usageMetricId":"um_api"}'),
    ("season", "COMPLETED", "1997-06-01", "1998-02-14", False, None,
     '{"pricingType":"LINEAR","pricePerUnit":"2.00","isPricePercentage":false,"usageMetricId":"um_season"}'),
    ("season", "ACTIVE", "1998-02-15", None, False, None,
     '{"pricingType":"LINEAR","pricePerUnit":"4.00","isPricePercentage":false,"usageMetricId":"um_season"}'),
]

# id, name, property filters, properties to negate
METRICS = [
    ("um_cashout", "Cash-out transactions", '{"flow":["PAYOUT"],"validation":["strict"]}', None),
    ("um_cashin", "Cash-in transactions", '{"flow":["payin"]}', None),
    ("um_debit", "Direct debits", '{"transaction_type":["DAC_DEBIT","BALANCE RECHARGE"]}', None),
    ("um_cross", "Cross-border transactions", '{"country":["COLOMBIA"],"flow":["PAYOUT","PAYIN"]}', '["country"]'),
    ("um_priority", "Priority banks", '{"destination_bank":["BUILDING","AUTOMOBILE","MACHINERY"]}', "[]"),
    ("um_api", "API transactions", '{"origination_system":["api_gateway"]}', None),
    ("um_mixed", "Finished transactions", '{"status":"FINISHED","source_account_type":["OWN BALANCE"]}', None),
    ("um_empty", "Connected accounts", '{"source_account_type":["CONNECT"],"colour":["RED"]}', None),
    ("um_season", "Portal except finished", '{"origination_system":["PORTAL"],"status":["FINISHED"]}',
     '["status"]'),
]

# First day of each billed month and the last day of its billing period.
MONTHS = [
    (0, "1997-12-01", "1997-12-31"),
    (1, "1998-01-01", "1998-01-31"),
    (2, "1998-02-01", "1998-02-28"),
    (3, "1998-03-01", "1998-03-31"),
    (4, "1998-04-01", "1998-04-30"),
]

CLIENTS_PER_CUSTOMER = 15
