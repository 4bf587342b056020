"""Booking-risk analytics as PySpark DataFrame operators.

``sources``    typed readers, writers and the adapters over the test tables
``functions``  column expressions: calendar, codes, ratios
``operators``  DataFrame-in, DataFrame-out steps
``plans``      the wide feature plan and the registered queries
"""
