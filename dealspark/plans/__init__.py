"""dealspark.plans"""
