"""quernstone.plans"""
