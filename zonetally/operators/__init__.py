"""DataFrame operators.

They only build plans; `requests.answer_requests` and `generate.sample_items` also
look at the size of what they would broadcast.
"""
