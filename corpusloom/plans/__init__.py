"""corpusloom.plans"""
