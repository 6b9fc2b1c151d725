"""amity.sources"""
