"""The registered queries and the SQL each must agree with.

Every module holds ``CHECKS``: name -> (query, SQL or None).
"""
