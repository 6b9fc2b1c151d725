"""amity.plans"""
