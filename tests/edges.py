"""Edge messages with the rows they must give.

Fixed values: payload, reject reason, and one (gender, zip, registered, username)
per row.
"""

NOTHING = (None, None, None, None)

EDGES = {
    "ok": ('{"results":[{"user":{"gender":"f","location":{"zip":123},"registered":1300000000,"username":"u"}},'
           '{"user":{"gender":"m"}}],"nationality":"US",'
           '"tran_detail":{"tran_card_type":["Visa"],"product_id":"P","tran_amount":150.5}}',
           None, [("f", "123", 1300000000, "u"), ("m", None, None, None)]),
    "zip text": ('{"results":[{"user":{"gender":"f","location":{"zip":"AB1 2CD"},"registered":1300000000}}],'
                 '"nationality":"GB"}', None, [("f", "AB1 2CD", 1300000000, None)]),
    "leading zero": ('{"results":[{"user":{"location":{"zip":"01234"}}}]}', None, [(None, "01234", None, None)]),
    "quoted numbers": ('{"results":[{"user":{"location":{"zip":"12345"},"registered":"1300000000"}}]}',
                       "mistyped field", [(None, "12345", None, None)]),
    "int overflow": ('{"results":[{"user":{"registered":4102444800,"gender":"z"}}],"nationality":"FR"}',
                     None, [("z", None, 4102444800, None)]),
    "malformed": ('{"results":[{"us', "malformed", []),
    "empty array": ('{"results":[]}', "empty results", []),
    "no results": ('{"nationality":"US"}', "no results", []),
    "null users": ('{"results":[{"user":null},{}]}', None, [NOTHING, NOTHING]),
    "int amount": ('{"results":[{"user":{}}],"tran_detail":{"tran_amount":150}}', None, [NOTHING]),
    "quoted amount": ('{"results":[{"user":{}}],"tran_detail":{"tran_amount":"150.5"}}',
                      "mistyped field", [NOTHING]),
    "null payload": (None, "null payload", []),
    "numeric gender": ('{"results":[{"user":{"gender":5}}]}', None, [("5", None, None, None)]),
    "top-level array": ('[{"results":[{"user":{"gender":"q"}}]}]', "malformed", []),
    "no cards": ('{"results":[{"user":{"username":"n"}}],"tran_detail":{"tran_card_type":[],"tran_amount":1e300}}',
                 None, [(None, None, None, "n")]),
    "milliseconds": ('{"results":[{"user":{"registered":1300000000000}}]}', None,
                     [(None, None, 1300000000000, None)]),
    "far future": ('{"results":[{"user":{"registered":9223372036854775807}}]}', None,
                   [(None, None, 9223372036854775807, None)]),
}
