"""Star-schema analytics for business-messaging traffic, written as Spark DataFrame functions."""
