"""tidewatch: Spark-native network-traffic classification and analytics."""
__version__ = "0.1.0"
