"""dealspark.sources"""
