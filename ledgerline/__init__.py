"""Reusable Spark table operators for sales and people analytics.

``functions`` holds column expressions, ``sources`` readers, writers and catalog
helpers, ``operators`` the DataFrame-to-DataFrame operators, ``plans`` the
end-to-end jobs composed from them, and ``bindings`` the queries registered on
the shared test tables.
"""
