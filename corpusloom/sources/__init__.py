"""corpusloom.sources"""
