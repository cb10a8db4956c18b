"""dealspark.streaming"""
