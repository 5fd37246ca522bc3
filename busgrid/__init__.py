"""Bus timetable feeds to clean tables, GTFS and a wide analysis table, on Spark."""
