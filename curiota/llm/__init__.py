"""Training-data operators: ten document-level operators and their queries.

Nothing else in the library imports this package.  Every operator takes a
DataFrame plus the names of its id and text columns, reads only those columns
and gives back a DataFrame of its own columns, so extra columns of any name
never clash.
"""
