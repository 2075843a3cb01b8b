"""A layered, real-time e-commerce warehouse written as PySpark DataFrame functions.

Layers, in the order data moves through them: gate (``ods``), routed detail
streams (``dwd``), dimension tables (``dim``), 30-second window tables
(``dws``) and reporting views (``ads``).
"""
