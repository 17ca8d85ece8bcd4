"""marketlens — a PySpark-native market-data analytics engine.

Feeds of price ticks, order-book levels and executed trades are held as one
long DataFrame ``(seq, ts, us, currency, feed, cost, quantity)``.  Every
operator is a DataFrame/SQL transformation on that table (or on the wide
``trade_volume`` fact table derived from it), so Catalyst plans the work and
the same code runs in batch and in Structured Streaming.
"""

__version__ = "0.1.0"
