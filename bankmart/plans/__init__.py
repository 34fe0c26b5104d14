"""Plans: the layered lake, marts, analytics queries, views, dashboard
queries, the daily batch and the query catalogue."""
