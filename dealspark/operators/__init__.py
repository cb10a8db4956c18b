"""dealspark.operators"""
