"""Spark-native e-commerce analytics: sessions, revenue, fraud alerts, change data and daily reports.

Every operator is a function from DataFrame to DataFrame.
"""
